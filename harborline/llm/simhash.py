"""Near-duplicates by SimHash with bit-sliced comparison.

A text's fingerprint has 64 bits: a bit is 1 if it is set in over half of the XXH64 hashes of
the text's word shingles. Two fingerprints link when at most ``radius`` bits differ; the
components of the links are the groups.

Candidates. The bits are cut into radius + k blocks. Two fingerprints within the radius differ
in at most ``radius`` blocks, so they agree on some k blocks: every distinct fingerprint is
dealt once for each choice of k blocks, by their values. No link can be missed. k is two, for about
21 bits, until evenly spread fingerprints would fill buckets of ``CELL``, at two billion; then three,
for 27 bits.
A bucket of more than ``CELL`` fingerprints is cut in blocks of about ``CELL``: each member goes to the cells
(own block, other block), which together hold every pair, so no task receives an unbounded group and nothing
is dropped. Where that makes more cells than there are pairs of radius + 2 blocks, the bucket is counted as dealt
again by pairs of blocks of the bits it does not share yet, which finds the same links with rows that grow with
its members; it is dealt so if that compares fewer fingerprints. Only a bucket whose members agree in those bits
too, and so lie close together, stays in cells.

Comparison. Inside a cell, up to 64 fingerprints form a slice: word b of a slice holds bit
b of all its members. A query is compared with a slice by XOR of its own bit, spread over
the word, with each of the 64 words; carry-save adders count the differing bits of all
members at once, eight planes a step, in bit-sliced counters with a sticky overflow. After every step the
(query, slice) pairs whose members have all passed the radius are abandoned. From
the links of a cell only a spanning forest leaves it, so dense groups yield as many edges
as members.

Only distinct fingerprints are dealt; copies share one row. Text is read once, in Arrow
batches, whole and without a shuffle.

Defined results: ASCII letters are lower-cased; a text with fewer words than a shingle is
one shingle of all of them; a text without words, or null, has fingerprint zero and links
like any other. A null id never becomes a component's id unless all ids of the component are null.
Repeated rows share a component. An empty table gives an empty result. Very long texts are read whole. Other
columns pass through or play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate, combinations, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.llm.components import components
from harborline.llm.frames import packed, staged, text_of, unpacked

SHINGLE = 4
RADIUS = 4
SEED = 42
CELL = 1024
PROBES = 1 << 15  # (query, slice) pairs compared at once
STEP = 8  # planes between two looks at what can be abandoned


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one text, unsigned."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map((1).__add__, map(len, words))))  # one past the blank after each word
    starts = [0, *ends[:-shingle]] if len(words) > shingle else [0]
    stops = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b - 1], seed) for a, b in zip(starts, stops)], dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text_column: str = "text", out: str = "fp", shingle: int = SHINGLE,
                 seed: int = SEED) -> DataFrame:
    """Add ``out``, the fingerprint as a signed long, to all columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text")
            found = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(found.view(np.int64))],
                                             names=["_row", "_fp"])

    rows = packed(df, _text=text_of(text_column))
    schema = T.StructType([rows.schema["_row"], T.StructField("_fp", T.LongType())])
    return rows.mapInArrow(run, schema).select("_row.*", F.col("_fp").alias(out))


def block_masks(radius: int, agree: int = 2, bits: Sequence[int] = range(64)) -> list[int]:
    """A mask for every choice of ``agree`` out of radius + agree blocks of ``bits``, as signed longs."""
    blocks = radius + agree
    edges = [round(len(bits) * i / blocks) for i in range(blocks + 1)]
    masks = [sum(1 << k for k in bits[a:b]) for a, b in zip(edges, edges[1:])]
    return [signed(sum(chosen)) for chosen in combinations(masks, agree)]


def signed(word: int) -> int:
    return word - (1 << 64) if word >> 63 else word


def agreeing(total: int, radius: int, cell: int) -> int:
    """How many blocks shall agree, so that ``total`` evenly spread fingerprints make buckets of ``cell`` or less."""
    return next(k for k in count(2) if k == 8 or total * 2.0 ** (-64 * k / (radius + k)) <= cell)


def slices(prints: np.ndarray) -> np.ndarray:
    """Bit planes of up to 64 fingerprints a row: word b of a row holds bit b of its members."""
    bits = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(*prints.shape, 8), axis=2, bitorder="little")
    planes = np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(planes).view("<u8")[:, :, 0]


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: sum and carry of three words, bit by bit."""
    both = a ^ b
    return both ^ c, (a & b) | (both & c)


def within(queries: np.ndarray, rows: np.ndarray, planes: np.ndarray, radius: int) -> np.ndarray:
    """For each (query, slice) pair the members of the slice within the radius, as a word of bits."""
    found = np.zeros(len(queries), dtype=np.uint64)
    live = np.arange(len(queries))
    # Digits of the counters: ones, twos, fours, and more for a radius of eight and above.
    digits = [np.zeros(len(queries), dtype=np.uint64) for _ in range(max(3, radius.bit_length()))]
    over = np.zeros(len(queries), dtype=np.uint64)
    for start in range(0, 64, STEP):
        differ = [planes[rows, bit] ^ (np.uint64(0) - ((queries >> np.uint64(bit)) & np.uint64(1)))
                  for bit in range(start, start + STEP)]
        carries = []
        for x, y in zip(differ[::2], differ[1::2]):
            digits[0], carry = _add(digits[0], x, y)
            carries.append(carry)
        digits[1], low = _add(digits[1], carries[0], carries[1])
        digits[1], high = _add(digits[1], carries[2], carries[3])
        digits[2], carry = _add(digits[2], low, high)
        for k in range(3, len(digits)):
            digits[k], carry = digits[k] ^ carry, digits[k] & carry
        over |= carry  # beyond the last digit the count stays above the radius
        above, equal = over.copy(), ~over
        for k in reversed(range(len(digits))):
            if radius >> k & 1:
                equal &= digits[k]
            else:
                above |= equal & digits[k]
                equal &= ~digits[k]
        left = ~above != 0
        if not left.all():
            live, queries, rows, over, above = live[left], queries[left], rows[left], over[left], above[left]
            digits = [d[left] for d in digits]
            if not len(live):
                return found
    found[live] = ~above
    return found


def cell_edges(cells: list[np.ndarray], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links inside each cell of distinct fingerprints."""
    members, counts, first = [], [], []
    total = 0
    for cell in cells:
        n = -(-len(cell) // 64)
        padded = np.zeros(64 * n, dtype=np.uint64)
        padded[:len(cell)] = cell
        members.append(padded.reshape(n, 64))
        first.append(total)
        counts.append(n)
        total += n
    planes = slices(np.concatenate(members))
    sizes = np.array([len(c) for c in cells])
    # Every query of a cell meets every slice of the cell.
    queries = np.concatenate([np.repeat(c, n) for c, n in zip(cells, counts)])
    rows = np.concatenate([np.tile(np.arange(f, f + n), len(c)) for c, f, n in zip(cells, first, counts)])
    words = np.concatenate([within(queries[i:i + PROBES], rows[i:i + PROBES], planes, radius)
                            for i in range(0, len(queries), PROBES)])
    edges, at = [], 0
    for cell, size, n in zip(cells, sizes.tolist(), counts):
        links = words[at:at + size * n].reshape(size, n)
        at += size * n
        unseen = (1 << size) - 1  # lanes beyond the cell are never looked at
        while unseen:
            root = (unseen & -unseen).bit_length() - 1
            unseen &= unseen - 1
            queue = [root]
            while queue and unseen:
                here = queue.pop()
                new = int.from_bytes(links[here].astype("<u8").tobytes(), "little") & unseen
                unseen ^= new
                while new:
                    there = (new & -new).bit_length() - 1
                    new &= new - 1
                    edges.append((int(cell[here]), int(cell[there])))
                    queue.append(there)
    return edges


def _buckets(dealt: DataFrame, cell: int) -> DataFrame:
    """``path``, ``value``, ``members`` and the number of ``blocks`` of every bucket with a pair."""
    # A bucket of one has no pair; the inner join with this frame drops it.
    return dealt.groupBy("path", "value").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select(
        "*", F.ceil(F.col("members") / cell).cast("int").alias("blocks"))


def _cells(prints: DataFrame, radius: int, cell: int, agree: int | None = None) -> DataFrame:
    """Rows of ``path``, ``value``, ``i``, ``j`` and ``fp`` of all cells with a chance of a link."""
    first = block_masks(radius, agree or agreeing(prints.count(), radius, cell))
    masks = F.array(*[F.struct(F.lit(k).alias("path"), F.lit(m).alias("bits")) for k, m in enumerate(first)])
    dealt = staged(prints.select("fp", F.inline(masks)).select(
        "path", F.col("fp").bitwiseAND(F.col("bits")).alias("value"), "fp"), "dealt")
    buckets = staged(_buckets(dealt, cell), "buckets")
    again = [block_masks(radius, 2, [b for b in range(64) if not m >> b & 1]) for m in first]
    wide = buckets.filter(F.col("blocks") > len(again[0]))
    if not wide.isEmpty():
        dealt, buckets = _dealt_again(dealt, buckets, wide, first, again, cell)
    met = dealt.join(buckets.select("path", "value", "blocks"), ["path", "value"])
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    met = met.select("path", "value", "fp", own.alias("own"), F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return met.select("path", "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")


def _dealt_again(dealt: DataFrame, buckets: DataFrame, wide: DataFrame, first: list[int], again: list[list[int]],
                 cell: int) -> tuple[DataFrame, DataFrame]:
    """Rows and buckets with those of ``wide`` replaced where dealing them by further blocks costs less.

    A path below ``len(first)`` is a choice of blocks; above, the choice ``path // step - 1`` and a further one.
    """
    step = max(len(first), len(again[0]))
    more = F.array(*[
        F.array(*[F.struct(F.lit((k + 1) * step + i).alias("deeper"), F.lit(m | x).alias("bits")) for i, x in enumerate(own)])
        for k, (m, own) in enumerate(zip(first, again))])
    deeper = staged(dealt.join(wide.select("path", "value"), ["path", "value"]).select(
        "fp", F.inline(more[F.col("path")])).select(
        F.col("deeper").alias("path"), F.col("fp").bitwiseAND(F.col("bits")).alias("value"), "fp"), "dealt-again")
    found = staged(_buckets(deeper, cell), "buckets-again")

    def parent() -> list[Column]:
        above = (F.floor(F.col("path") / step) - 1).cast("int")
        bits = F.array(*[F.lit(m) for m in first])[above]
        return [above.alias("above"), F.col("value").bitwiseAND(bits).alias("root")]

    def compared() -> Column:
        return F.col("members").cast("double") * F.col("blocks")

    own = found.select(*parent(), compared().alias("cost")).groupBy("above", "root").agg(F.sum("cost").alias("cost"))
    chosen = wide.join(own, (F.col("path") == F.col("above")) & (F.col("value") == F.col("root")), "left").filter(
        F.coalesce("cost", F.lit(0.0)) < compared())
    chosen = staged(chosen.select(F.col("path").alias("above"), F.col("value").alias("root")), "buckets-replaced")

    kept = buckets.join(chosen, (F.col("path") == F.col("above")) & (F.col("value") == F.col("root")), "left_anti")
    added = found.select("*", *parent()).join(chosen, ["above", "root"], "left_semi").select(*buckets.columns)
    return dealt.unionByName(deeper), staged(kept.unionByName(added), "buckets-of-both")


def links(prints: DataFrame, radius: int = RADIUS, cell: int = CELL, agree: int | None = None) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints ``fp``: a spanning forest of every cell.

    ``agree`` is the number of blocks that share a bucket's value, chosen by the number of fingerprints if it is not given.
    """
    keys = ["path", "value", "i", "j"]
    types = {"path": np.int64, "value": np.int64, "i": np.int64, "j": np.int64}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last cell, which may go on in the next batch
        for batch in batches:
            now = [batch.column(k).to_numpy().astype(t) for k, t in types.items()]
            now.append(batch.column("fp").to_numpy().view(np.uint64))
            if held is not None:
                now = [np.concatenate(pair) for pair in zip(held, now)]
            held = now
            if len(now[0]) < 1 << 14:
                continue
            starts = _starts(now)
            cut = starts[-1]
            held = [c[cut:] for c in now]
            if cut:
                yield _batch([c[:cut] for c in now], radius)
        if held is not None:
            yield _batch(held, radius)

    cells = _cells(prints, radius, cell, agree)
    placed = cells.repartition(*keys).sortWithinPartitions(*keys)
    return placed.mapInArrow(run, "a bigint, b bigint").distinct()


def _starts(columns: list[np.ndarray]) -> np.ndarray:
    new = np.zeros(len(columns[0]), dtype=bool)
    new[0] = True
    for c in columns[:-1]:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _batch(columns: list[np.ndarray], radius: int) -> pa.RecordBatch:
    starts = _starts(columns)
    cells = [c for c in np.split(columns[-1], starts[1:]) if len(c) > 1]
    found = np.array(cell_edges(cells, radius) if cells else [], dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id`` (least id of its group)."""
    narrow = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_t"))
    narrow = staged(fingerprints(narrow, "_t", "fp", shingle).select("_id", "fp"), "fingerprints")
    return _grouped(narrow, radius, cell).select(
        F.col("_id").alias(id_column), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _grouped(narrow: DataFrame, radius: int, cell: int) -> DataFrame:
    """Rows with ``_id`` and ``fp``, and the ``root`` and ``component_id`` of their group."""
    prints = staged(narrow.groupBy("fp").agg(F.min("_id").alias("least")), "prints")
    roots = components(links(prints.select("fp"), radius, cell))
    rooted = prints.join(staged(roots.select(F.col("node").alias("fp"), "root"), "roots"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = staged(rooted, "rooted")
    ids = staged(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    named = staged(rooted.select("fp", "root").join(ids, "root").select("fp", "root", "component_id"), "named")
    return narrow.join(named, "fp")


def drop_near(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE,
              radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """One document of each group, the one with the least id, with all its columns."""
    key = F.coalesce(F.concat(F.lit("="), F.col(id_column).cast("string")), F.lit("null"))
    content = F.unhex(F.sha2(text_of(text_column), 256))
    narrow = docs.select(F.col(id_column).alias("_id"), key.alias("_key"), content.alias("_sha"),
                         F.col(text_column).alias("_t"))
    narrow = staged(fingerprints(narrow, "_t", "fp", shingle).drop("_t"), "fingerprints")
    order = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_key"), F.col("_sha")))
    kept = _grouped(narrow, radius, cell).groupBy("root").agg(order.alias("first"))
    kept = staged(kept.select("first._key", "first._sha"), "kept")
    rows = packed(docs, _key=key, _sha=content)
    # Rows that repeat id and text are all found; one of them stays.
    return unpacked(rows.join(kept, ["_key", "_sha"], "left_semi").dropDuplicates(["_key", "_sha"]))

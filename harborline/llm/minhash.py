"""Near-duplicates by fast similarity sketches, banding and exact verification.

A document's set holds the distinct shingles of its words, as 64-bit hashes. Its sketch has
``BANDS * ROWS`` coordinates and is filled in rounds: in each of the first rounds, one per coordinate, every element is
hashed to a bin with a value, and an empty bin takes the least value that falls into it; in the
rounds after those, every element goes to the one bin of the round, so all bins are full at the end. A
set of a few hundred elements is done after two rounds or so, and a set of one needs all of them. A coordinate of two
sets agrees with a probability of their similarity, and the share of agreeing coordinates keeps
within Chernoff-like bounds, which independent samples with empty bins would not.

Banding. Sets that agree in all ``ROWS`` coordinates of one of ``BANDS`` bands meet in a bucket. At the least
similarity of 0.8 a pair is missed with probability (1 - 0.8**5)**32 = 3e-6, at 0.85 with 7e-9.

Verification on full sets, in two steps. First each member of a bucket is compared with the
least member (its centre), which settles most buckets; a centre with many members is dealt out in
shares of ``SHARE``. Buckets that still hold more than one component are then compared whole: they are
dealt in blocks of bounded size, each member goes to the cells (own block, other block), which
together hold every pair, and a cell counts the intersections of its sets through postings and emits a
spanning forest of links only. So no link of a bucket is lost, no list of pairs is made, and no task
holds an unbounded group. Compressed texts travel instead of sets.

Only one document of each distinct set is sketched into buckets. Components come from
``components``; all intermediate frames lie in the shared folder.

Defined results: ASCII letters are lower-cased; a text with fewer words than a shingle is
one shingle of all of them; a text without words, or null, has an empty set and is a component
of its own. A null id never names a component unless all ids in it are null, and such a row counts as
kept. Rows that repeat id and text get equal results. An empty table gives an empty result. Very long
texts are read whole. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.llm.components import components
from harborline.llm.frames import packed, staged, text_of

SHINGLE = 4
PERCENT = 80
BANDS = 32
ROWS = 5
SHARE = 256  # members that meet a copy of their centre
CELL = 512  # members of a block
WEIGHT = 1 << 21  # shingles of a block
TOGETHER = 1 << 19  # shingles that are sketched at once
VALUE = 40  # bits of a value; the round stands above them


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of the shingles of one text."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(map((1).__add__, map(len, words))))  # one past the blank after each word
    starts = [0, *ends[:-size]] if len(words) > size else [0]
    stops = ends[size - 1:] if len(words) >= size else ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b - 1]) for a, b in zip(starts, stops)], dtype=np.uint64))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """A row of ``bins`` coordinates for every set; none of the sets may be empty."""
    empty = np.uint64(np.iinfo(np.uint64).max)
    out = np.full((len(sets), bins), empty, np.uint64)
    flat = out.reshape(-1)
    elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    step = np.uint64(0x9E3779B97F4A7C15)
    for turn in range(2 * bins):
        if not len(elements):
            break
        drawn = _mixed(elements ^ _mixed(np.array([turn + 1], np.uint64) * step))
        place = owner * bins
        if turn < bins:
            place += ((drawn >> np.uint64(VALUE)) * np.uint64(bins) >> np.uint64(64 - VALUE)).astype(np.int64)
        else:
            place += turn - bins
        value = np.uint64(turn << VALUE) | (drawn & np.uint64((1 << VALUE) - 1))
        # A bin that an earlier round has filled holds less, so only empty ones change.
        np.minimum.at(flat, place, value)
        left = (out == empty).any(axis=1)[owner]
        if not left.all():
            elements, owner = elements[left], owner[left]
    return out


def band_keys(rows: np.ndarray, bands: int) -> np.ndarray:
    """One key for every band of every sketch."""
    keys = np.tile(_mixed(np.arange(1, bands + 1, dtype=np.uint64)), (len(rows), 1))
    parts = rows.reshape(len(rows), bands, -1)
    for i in range(parts.shape[2]):
        keys = _mixed(keys ^ parts[:, :, i])
    return keys.view(np.int64)


def sketched(df: DataFrame, text_column: str = "text", shingle: int = SHINGLE, bands: int = BANDS,
             rows: int = ROWS) -> DataFrame:
    """All columns, and ``n_shingles``, ``digest`` (128 bits of the set) and ``bands``; the last two null for empty sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text")
            start, sets, size = 0, [], 0
            for i in range(len(texts)):
                sets.append(shingles(texts[i].as_py(), shingle))
                size += len(sets[-1])
                if size >= TOGETHER or i == len(texts) - 1:
                    yield some(batch.column("_row").slice(start, len(sets)), sets)
                    start, sets, size = i + 1, [], 0

    def some(kept: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
        full = [s for s in sets if len(s)]
        keys = iter(band_keys(sketches(full, bands * rows), bands) if full else ())
        return pa.RecordBatch.from_arrays([
            kept, pa.array([len(s) for s in sets], pa.int64()),
            pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
            pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
        ], names=["_row", "n", "digest", "bands"])

    inner = packed(df, _text=text_of(text_column))
    schema = T.StructType([inner.schema["_row"], T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()),
                           T.StructField("bands", T.ArrayType(T.LongType()))])
    return inner.mapInArrow(run, schema).select("_row.*", F.col("n").alias("n_shingles"), "digest", "bands")


def linked(a: int, b: int, both: np.ndarray | int, percent: int) -> np.ndarray | bool:
    """Whether sets of ``a`` and ``b`` elements that share ``both`` are similar enough."""
    return 100 * both >= percent * (a + b - both)


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _texts(docs: DataFrame, text_column: str, nodes: DataFrame) -> DataFrame:
    """``node`` and compressed ``text`` of the given rows of ``node`` and ``key``, one text each.

    The nodes grow with the corpus, so the join is a merge join at every size, and texts are compressed before
    they are shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            pressed = [press.compress(t.as_py().encode()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(pressed, pa.binary())], names=["key", "text"])

    rows = docs.select(_key(text_of(text_column)).alias("key"), text_of(text_column).alias("text"))
    rows = rows.mapInArrow(run, "key binary, text binary")
    return staged(rows.hint("merge").join(nodes, "key").dropDuplicates(["node"]).select("node", "text"), "texts")


def _set_of(pressed: pa.Scalar, shingle: int) -> np.ndarray:
    return shingles(zstandard.decompress(pressed.as_py()).decode(), shingle)


def star_links(stars: DataFrame, texts: DataFrame, shingle: int, percent: int, share: int = SHARE) -> DataFrame:
    """Verified links ``a``, ``b`` among rows of ``center`` and ``node``."""
    shares = staged(stars.groupBy("center").agg(F.ceil(F.count(F.lit(1)) / share).cast("int").alias("shares")), "shares")
    members = stars.join(shares, "center").select(
        "center", F.pmod(F.xxhash64("node"), F.col("shares")).cast("int").alias("share"), "node")
    centres = shares.select("center", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"),
                            F.col("center").alias("node"))
    rows = members.unionByName(centres).join(texts, "node")
    rows = rows.select("center", "share", (F.col("node") != F.col("center")).alias("other"), "node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, None
        for batch in batches:
            found = []
            columns = [batch.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("center", "share", "other", "node")]
            for i, (center, part, other, node) in enumerate(zip(*columns)):
                mine = _set_of(batch.column("text")[i], shingle)
                if not other:
                    held, own = (center, part), mine
                    continue
                if held != (center, part):
                    raise ValueError("a centre has no text")
                small, large = sorted((own, mine), key=len)
                if not linked(len(small), len(large), len(small), percent):
                    continue
                at = np.searchsorted(large, small)
                both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                if linked(len(own), len(mine), both, percent):
                    found.append((center, node))
            yield _edges(found)

    placed = rows.repartition("center", "share").sortWithinPartitions("center", "share", "other")
    return placed.mapInArrow(run, "a bigint, b bigint")


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


def cell_links(nodes: list[int], roots: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between the sets of a cell that join different roots: a spanning forest of them."""
    names = {r: r for r in roots}

    def top(x: int) -> int:
        while names[x] != x:
            names[x] = names[names[x]]
            x = names[x]
        return x

    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    postings, ends = owner[order], np.cumsum(np.bincount(column))
    starts = np.append(0, ends[:-1])
    first = np.append(0, np.cumsum([len(s) for s in sets]))
    sizes = np.diff(first)
    found, apart = [], len(names)
    for i in range(len(sets)):
        if apart == 1:
            break
        mine = column[first[i]:first[i + 1]]
        many = ends[mine] - starts[mine]
        before = np.cumsum(many) - many
        met = postings[np.arange(int(many.sum())) + np.repeat(starts[mine] - before, many)]
        both = np.bincount(met, minlength=len(sets))
        for j in np.flatnonzero(linked(sizes[i], sizes, both, percent)).tolist():
            x, y = top(roots[i]), top(roots[j])
            if x != y:
                names[max(x, y)] = min(x, y)
                found.append((nodes[i], nodes[j]))
                apart -= 1
    return found


def bucket_links(members: DataFrame, texts: DataFrame, shingle: int, percent: int, cell: int = CELL) -> DataFrame:
    """Links ``a``, ``b`` among rows of ``band``, ``node``, ``root`` and ``n`` that meet in a band and differ in root."""
    count = F.greatest(F.ceil(F.count(F.lit(1)) / cell), F.ceil(F.sum("n") / WEIGHT)).cast("int")
    blocks = staged(members.groupBy("band").agg(count.alias("blocks")), "blocks")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own")
    dealt = members.join(blocks, "band").select("band", "node", "root", own, F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "root")
    keys = ["band", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, roots, sets = None, [], [], []
        for batch in batches:
            found = []
            columns = [batch.column(c).to_numpy().tolist() for c in (*keys, "node", "root")]
            for i, (*key, node, root) in enumerate(zip(*columns)):
                if key != now:
                    if len(set(roots)) > 1:
                        found += cell_links(nodes, roots, sets, percent)
                    now, nodes, roots, sets = key, [], [], []
                nodes.append(node)
                roots.append(root)
                sets.append(_set_of(batch.column("text")[i], shingle))
            yield _edges(found)
        if len(set(roots)) > 1:
            yield _edges(cell_links(nodes, roots, sets, percent))

    placed = dealt.join(texts, "node").repartition(*keys).sortWithinPartitions(*keys)
    return placed.mapInArrow(run, "a bigint, b bigint")


def set_links(docs: DataFrame, classes: DataFrame, text_column: str, shingle: int, percent: int,
              cell: int = CELL, share: int = SHARE) -> DataFrame:
    """``node`` and ``root`` of every linked one of the stored ``classes`` (``node``, ``key``, ``n``, ``bands``)."""
    dealt = classes.select("node", "n", F.explode("bands").alias("band"))
    buckets = dealt.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("center"))
    buckets = staged(buckets.filter("size > 1"), "buckets")
    met = staged(dealt.hint("merge").join(buckets, "band"), "met")
    stars = staged(met.filter("node <> center").select("center", "node").distinct(), "stars")
    used = stars.select("node").union(stars.select("center")).distinct()
    texts = _texts(docs, text_column, staged(classes.select("node", "key").join(used, "node"), "used"))
    links = staged(star_links(stars, texts, shingle, percent, share), "links")
    roots = staged(components(links), "roots")
    # Pairs with the centre are settled; what is left are larger buckets with more than one component.
    rooted = met.filter("size > 2").join(roots, "node", "left").select(
        "band", "node", "n", F.coalesce("root", "node").alias("root"))
    rooted = staged(rooted, "rooted")
    mixed = staged(rooted.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"))
                   .filter("low < high").select("band"), "mixed")
    more = staged(bucket_links(rooted.join(mixed, "band"), texts, shingle, percent, cell), "more")
    if more.isEmpty():
        return roots
    return staged(components(links.union(more)), "roots")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, cell: int = CELL,
                    share: int = SHARE) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (least id of its group) and ``kept``."""
    if not 0 < percent <= 100:
        raise ValueError("percent is above 0 and at most 100")
    narrow = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_t"))
    narrow = sketched(narrow.withColumn("key", _key(text_of("_t"))), "_t", shingle, bands, rows)
    narrow = staged(narrow.drop("_t"), "sketches")
    classes = narrow.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min("key").alias("key"), F.min("_id").alias("least"), F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands"))
    # Numbered as they are written, so the numbers are fixed.
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    roots = set_links(docs, classes, text_column, shingle, percent, cell, share)
    rooted = classes.join(roots, "node", "left").select("digest", "least", F.coalesce("root", "node").alias("root"))
    rooted = staged(rooted, "rooted")
    least = staged(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = staged(rooted.join(least, "root").select("digest", "component_id"), "named")
    known = narrow.select("_id", "n_shingles", "digest")
    out = known.filter("digest IS NOT NULL").join(named, "digest").select("_id", "n_shingles", "component_id").unionByName(
        known.filter("digest IS NULL").select("_id", "n_shingles", F.col("_id").alias("component_id")))
    return out.select(F.col("_id").alias(id_column), "n_shingles", "component_id",
                      F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))

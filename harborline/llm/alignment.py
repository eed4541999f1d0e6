"""Alignment of the tokens of two tokenizers over the same text.

The operator compares a byte-level BPE file (A) with a sentencepiece model (B). Both cut the same
bytes, a blank and then the text. Token-byte incidence matrices in compressed sparse rows say which bytes a token
covers. Gustavson's row products of A and the transposed B give the overlap links: row i sums,
over the bytes of A's token i, the rows of those bytes, so an entry is the number of bytes two tokens
share. Places where tokens of both end cut the text into groups; the same product of the
group incidences gives the links between tokens of one group.

Corpus counts of linked id pairs travel through block dictionaries. A task gathers documents
into blocks of about ``BLOCK`` pairs; a block keeps its distinct pairs once, and each document
its links as numbers into that list. The dictionaries are summed before and in the shuffle,
joined with the corpus counts and returned to their block, where each document adds up its own
links. A pair occurs once in a block, so a hot pair sends a row per block, not per link;
nothing is broadcast, and a task holds one block. Repeated texts are counted like any others.

Defined results: a text that is null or empty, or whose tokens of A or B do not give back exactly its
bytes, has no tokens, no links and the empty digest, and adds nothing to the counts. Repeated
rows get a row each and count each time. A null id passes through; an empty table gives an empty result. Very long texts are
cut whole; a text with more pairs than a block is a block of its own. Other columns
play no part, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from harborline.llm.frames import staged

BLOCK = 1 << 21  # document-pair entries of a block
BYTES = 1 << 20  # bytes of text that are aligned together
CHUNK = 1 << 16  # pairs of a dictionary row
NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


class Sparse(NamedTuple):
    """A matrix in compressed sparse rows; ``data`` are the entries."""

    ptr: np.ndarray
    cols: np.ndarray
    data: np.ndarray
    width: int

    @property
    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))


def incidence(ptr: np.ndarray, cols: np.ndarray, width: int) -> Sparse:
    """A 0/1 matrix."""
    return Sparse(ptr, cols, np.ones(len(cols), np.int64), width)


def product(a: Sparse, b: Sparse) -> Sparse:
    """``a`` times ``b`` by rows: every entry (i, k) of ``a`` brings row k of ``b``, and equal columns are summed."""
    brought = np.diff(b.ptr)[a.cols]
    first = np.cumsum(brought) - brought
    at = np.arange(int(brought.sum())) + np.repeat(b.ptr[a.cols] - first, brought)
    rows, cols = np.repeat(a.rows, brought), b.cols[at]
    values = np.repeat(a.data, brought) * b.data[at]
    key = rows * b.width + cols
    if len(key) > 1 and (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, values = key[order], values[order]
    new = np.flatnonzero(np.diff(key, prepend=-1)) if len(key) else np.empty(0, np.int64)
    key, values = key[new], np.add.reduceat(values, new) if len(new) else values
    ptr = np.zeros(len(a.ptr), np.int64)
    np.cumsum(np.bincount(key // b.width, minlength=len(a.ptr) - 1), out=ptr[1:])
    return Sparse(ptr, key % b.width, values, b.width)


class Aligned(NamedTuple):
    """Tokens of texts laid end to end, and how they meet."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    group_a: np.ndarray  # the group of every token
    group_b: np.ndarray
    links: Sparse  # overlap in bytes of A's and B's tokens


def align(ids_a: np.ndarray, ids_b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> Aligned:
    """Overlaps and groups of two sequences of tokens that cover the same bytes."""
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    total = int(ends_a[-1]) if len(ends_a) else 0
    both = np.zeros(total + 1, np.int8)
    both[ends_a] += 1
    both[ends_b] += 1
    groups = [np.cumsum(both[e] == 2) - (both[e] == 2) for e in (ends_a, ends_b)]
    by_byte = np.arange(total)
    a = incidence(np.concatenate([[0], ends_a]), by_byte, total)
    # Transposed B: the row of a byte holds the token that covers it.
    b = incidence(np.arange(total + 1), np.repeat(np.arange(len(ids_b)), sizes_b), len(ids_b))
    return Aligned(ids_a, ids_b, *groups, product(a, b))


def group_links(found: Aligned) -> Iterator[Sparse]:
    """Links between tokens of the same group, in blocks of A's rows, so that long groups stay bounded.

    Row 0 of a block is the row after the last one of the block before.
    """
    sizes = np.bincount(found.group_b)
    b = incidence(np.concatenate([[0], np.cumsum(sizes)]), np.arange(len(found.ids_b)), len(found.ids_b))
    reach = np.cumsum(sizes[found.group_a])
    start = 0
    while start < len(found.ids_a):
        done = reach[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(reach, done + BLOCK, side="right")))
        yield product(incidence(np.arange(stop - start + 1), found.group_a[start:stop], len(sizes)), b)
        start = stop


def _byte_symbols() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones stand for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizer(NamedTuple):
    """Ids of texts, and the bytes of every id."""

    ids: object
    tokens: list[bytes]


@lru_cache(maxsize=4)
def byte_level(path: str) -> Tokenizer:
    """A byte-level BPE file; special strings inside texts are plain text.

    Where ids follow the order of merges and nothing but the usual pattern cuts the text, the same ids are found
    several times faster by ranks (the tests compare both libraries over all characters).
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer as Library

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    symbols, vocabulary = _byte_symbols(), spec["model"]["vocab"]
    tokens = [b""] * (1 + max(vocabulary.values()))
    special = {t["content"] for t in spec["added_tokens"]}
    for token, number in vocabulary.items():
        tokens[number] = token.encode() if token in special else bytes(map(symbols.__getitem__, token))
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    cut = spec["pre_tokenizer"] or {}
    plain = (cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
             and spec["normalizer"] is None and not spec["model"].get("ignore_merges")
             and all(vocabulary.get(a + b) == 256 + i for i, (a, b) in enumerate(pairs))
             and all(vocabulary.get(c, 256) < 256 for c in symbols))
    if plain:
        ranks = {tokens[n]: n for n in range(256 + len(pairs))}
        made = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return Tokenizer(lambda texts: list(map(made.encode_ordinary, texts)), tokens)
    library = Library.from_file(path)
    library.encode_special_tokens = True
    library.no_truncation()
    library.no_padding()
    return Tokenizer(lambda texts: [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)], tokens)


@lru_cache(maxsize=4)
def pieces(path: str) -> Tokenizer:
    """A sentencepiece model: U+2581 is a blank, byte pieces are their byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    tokens = [bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()
              for i, name in enumerate(names)]
    return Tokenizer(lambda texts: model.encode(texts, num_threads=1), tokens)


def _tokens_of(texts: list[str], path_a: str, path_b: str) -> tuple[list[list[int]], list[list[int]]]:
    """Ids of A and B for every text; none where the bytes of either differ from the blank and the text."""
    a, b = byte_level(path_a), pieces(path_b)
    many_a, many_b = a.ids([" " + t for t in texts]), b.ids(texts)
    for i, text in enumerate(texts):
        data = b" " + text.encode()
        if not text or any(b"".join(map(tokens.__getitem__, ids)) != data
                           for tokens, ids in ((a.tokens, many_a[i]), (b.tokens, many_b[i]))):
            many_a[i], many_b[i] = [], []
    return many_a, many_b


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter((x for ids in lists for x in ids), np.int64, sum(map(len, lists)))


@lru_cache(maxsize=4)
def _tables(path_a: str, path_b: str) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Token sizes in bytes, and how an id is written: of A within and at the end of its half, then of B."""
    a, b = byte_level(path_a).tokens, pieces(path_b).tokens
    written = [b"%d%s" % (i, mark) for size, marks in ((len(a), b",|"), (len(b), b",;"))
               for mark in (marks[:1], marks[1:]) for i in range(size)]
    return np.array([*map(len, a)]), np.array([*map(len, b)]), written


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts, about ``BYTES`` at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            text = batch.column("_t")[i].as_py() or ""
            ids.append(batch.column("_id")[i].as_py())
            texts.append(text)
            size += len(text)
            if size >= BYTES or len(ids) >= 1000:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _measured(texts: list[str], path_a: str, path_b: str) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
    """For every text its four numbers and its digest; and its distinct pairs with their text and how often they are linked."""
    sizes_a, sizes_b, written = _tables(path_a, path_b)
    many_a, many_b = _tokens_of(texts, path_a, path_b)
    counts_a, counts_b = np.array([*map(len, many_a)]), np.array([*map(len, many_b)])
    ids_a, ids_b = _flat(many_a), _flat(many_b)
    found = align(ids_a, ids_b, sizes_a[ids_a], sizes_b[ids_b])
    n_groups = int(found.group_a[-1]) + 1 if len(ids_a) else 0
    in_a, in_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=n_groups))]) for g in (found.group_a, found.group_b))
    # A group is written as its tokens of A, then its tokens of B.
    last_a, last_b = (np.append(np.diff(g) > 0, True) if len(g) else np.empty(0, bool) for g in (found.group_a, found.group_b))
    order = np.empty(len(ids_a) + len(ids_b), np.int64)
    order[np.arange(len(ids_a)) + in_b[found.group_a]] = ids_a + last_a * len(sizes_a)
    order[np.arange(len(ids_b)) + in_a[found.group_b + 1]] = ids_b + 2 * len(sizes_a) + last_b * len(sizes_b)
    text_a = np.repeat(np.arange(len(texts)), counts_a)
    groups = np.bincount(text_a[last_a], minlength=len(texts))
    rows = found.links.rows
    text_of = text_a[rows]
    links = np.bincount(text_of, minlength=len(texts))
    out, at = [], 0
    for a, b, g, n in zip(counts_a.tolist(), counts_b.tolist(), groups.tolist(), links.tolist()):
        told = b"".join(map(written.__getitem__, order[at:at + a + b].tolist()))[:-1]
        at += a + b
        out.append((a, b, g, n, hashlib.sha256(told).hexdigest() if a else ""))
    room = len(sizes_a) * len(sizes_b)
    keys, often = np.unique(text_of * room + ids_a[rows] * len(sizes_b) + ids_b[found.links.cols], return_counts=True)
    return out, keys // room, keys % room, often


def _packed_links(places: np.ndarray, often: np.ndarray) -> bytes:
    """Ascending places and their counts, as compressed byte planes of the steps between them."""
    both = np.concatenate([np.diff(places, prepend=0), often]).astype("<u4")
    return zstandard.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unpacked_links(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1).T.copy().view("<u4")[:, 0].astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


def _blocks(rows: DataFrame, path_a: str, path_b: str, room: int) -> DataFrame:
    """Stored rows of two kinds: pieces of block dictionaries (0), and documents (1); a block is full at ``room`` entries."""
    kind = rows.schema["_id"].dataType
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("kind", T.IntegerType()),
                           T.StructField("first", T.LongType()), T.StructField("pairs", T.ArrayType(T.LongType())),
                           T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("_id", kind),
                           *[T.StructField(n, T.LongType()) for n in NUMBERS],
                           T.StructField("groups_sha256", T.StringType()), T.StructField("links", T.BinaryType())])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def block(number: int, ids: list, told: list[tuple], parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        pairs, often = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
        texts = np.concatenate([p[0] for p in parts])
        known, places = np.unique(pairs, return_inverse=True)
        counts = np.bincount(places, weights=often, minlength=len(known)).astype(np.int64)
        for at in range(0, len(known), CHUNK):
            row = {"block": number, "kind": 0, "first": at, "pairs": known[at:at + CHUNK], "counts": counts[at:at + CHUNK]}
            yield pa.RecordBatch.from_pylist([row], schema=arrow)
        ends = np.searchsorted(texts, np.arange(len(ids) + 1))
        made = [{"block": number, "kind": 1, "_id": id_, **dict(zip([*NUMBERS, "groups_sha256"], t)),
                 "links": _packed_links(places[a:b], often[a:b])} for id_, t, a, b in zip(ids, told, ends, ends[1:])]
        for at in range(0, len(made), 500):
            yield pa.RecordBatch.from_pylist(made[at:at + 500], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, told, parts, size = [], [], [], 0
        for some, texts in _texts(batches):
            numbers, of, pairs, often = _measured(texts, path_a, path_b)
            parts.append((of + len(ids), pairs, often))
            ids += some
            told += numbers
            size += len(pairs)
            if size >= room:
                yield from block(number, ids, told, parts)
                number, ids, told, parts, size = number + 1, [], [], [], 0
        if ids:
            yield from block(number, ids, told, parts)

    return staged(rows.mapInArrow(run, schema), "alignment")


def pair_counts(blocks: DataFrame, size_b: int) -> DataFrame:
    """``pair``, its ``count`` over the corpus, and whether it is the ``best`` of its id of B."""
    told = blocks.filter("kind = 0").select(F.inline(F.arrays_zip("pairs", "counts")))
    counts = staged(told.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("count")), "pair-counts")
    id_b = (F.col("pair") % F.lit(size_b)).alias("b")
    highest = staged(counts.groupBy(id_b).agg(F.max("count").alias("highest")), "highest")
    return counts.select("pair", "count", id_b).join(highest, "b").select(
        "pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def alignment(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text",
              block: int = BLOCK) -> DataFrame:
    """One row per document: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    ``n_best`` counts the links whose pair is counted most among those of its id of B, and
    ``count_sum`` adds the corpus counts of the pairs of all links.
    """
    blocks = _blocks(docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_t")), path_a, path_b, block)
    size_b = len(pieces(path_b).tokens)
    listed = blocks.filter("kind = 0").select("block", "first", F.posexplode("pairs").alias("place", "pair"))
    known = listed.join(pair_counts(blocks, size_b), "pair").select(
        "block", F.lit(0).alias("kind"), (F.col("first") + F.col("place")).alias("place"), "count", "best")
    told = ["_id", *NUMBERS, "groups_sha256", "links"]
    both = known.unionByName(blocks.filter("kind = 1").select("block", "kind", *told), allowMissingColumns=True)
    kind = docs.schema[id_column].dataType
    schema = T.StructType([T.StructField(id_column, kind), *[T.StructField(n, T.LongType()) for n in
                          [*NUMBERS, "n_best", "count_sum"]], T.StructField("groups_sha256", T.StringType())])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, counts, best = None, [], None, None
        for batch in batches:
            blocks_, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            turns = np.flatnonzero((np.diff(blocks_) != 0) | (np.diff(kinds) != 0)) + 1
            for start, stop in zip([0, *turns], [*turns, batch.num_rows]):
                some = batch.slice(start, stop - start)
                if blocks_[start] != now:
                    now, parts, counts = blocks_[start], [], None
                if kinds[start] == 0:
                    parts.append((some.column("count").to_numpy(), some.column("best").to_numpy(zero_copy_only=False)))
                    continue
                if counts is None:
                    parts = parts or [(np.empty(0, np.int64), np.empty(0, bool))]
                    counts, best = (np.concatenate(x) for x in zip(*parts))
                    parts = []
                sums = []
                for links in some.column("links"):
                    places, often = _unpacked_links(links.as_py())
                    sums.append((int((often * best[places]).sum()), int((often * counts[places]).sum())))
                yield pa.RecordBatch.from_arrays([
                    some.column("_id"), *[some.column(n) for n in NUMBERS], pa.array([s[0] for s in sums], pa.int64()),
                    pa.array([s[1] for s in sums], pa.int64()), some.column("groups_sha256")], schema=arrow)

    placed = both.repartition("block").sortWithinPartitions("block", "kind", "place")
    return placed.mapInArrow(run, schema)


def token_links(docs: DataFrame, path_a: str, path_b: str, kind: str = "overlap", id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """The links themselves: id, ``token_a`` and ``token_b`` (places in the text), ``id_a``, ``id_b``, ``weight``.

    ``kind`` "overlap" links tokens that share ``weight`` bytes, "group" all tokens of the same group (weight 1).
    """
    if kind not in ("overlap", "group"):
        raise ValueError("kind is overlap or group")
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_t"))
    names = ["token_a", "token_b", "id_a", "id_b", "weight"]
    schema = T.StructType([T.StructField(id_column, rows.schema["_id"].dataType), *[T.StructField(n, T.LongType()) for n in names]])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes_a, sizes_b, _ = _tables(path_a, path_b)
        for some, texts in _texts(batches):
            for id_, a, b in zip(some, *_tokens_of(texts, path_a, path_b)):
                ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
                found = align(ids_a, ids_b, sizes_a[ids_a], sizes_b[ids_b])
                first = 0
                for links in [found.links] if kind == "overlap" else group_links(found):
                    at, to = links.rows + first, links.cols
                    first += len(links.ptr) - 1
                    columns = [at, to, ids_a[at], ids_b[to], links.data]
                    for cut in range(0, len(at), CHUNK):
                        part = [pa.array(c[cut:cut + CHUNK], pa.int64()) for c in columns]
                        ids = pa.array([id_] * len(part[0]), arrow.field(0).type)
                        yield pa.RecordBatch.from_arrays([ids, *part], schema=arrow)

    return rows.mapInArrow(run, schema)

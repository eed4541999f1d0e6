"""Byte-level BPE encoding and decoding by a rank file.

Text is cut by the pattern that belongs to the vocabulary. A piece that is a token
itself is that token; every other piece is merged with a segment tree over its byte
positions. Leaf i holds the rank of the pair of live neighbours that starts at byte i, or
nothing; every inner node holds the least (rank, position) below it, so the root names the
leftmost pair of least rank. A merge changes the pairs at the merged position and at its
live neighbours, three leaves, and each change climbs at most log2(n) levels: a piece
of n bytes costs O(n log n), also when it is a megabyte without a blank.

Encoding runs inside the tasks that read the text; no shuffle. Pieces that were merged are
remembered per worker in two generations of ``REMEMBERED`` bytes, and pieces over ``KEPT`` characters not at all, which
bounds memory and never changes a result. Long texts are cut piece by piece and never held as a list of all pieces.

Defined results: a null text encodes like the empty one, to no ids; decoding null or no
ids gives empty bytes, an id outside the vocabulary raises. Rows, order of columns and
other columns pass through unchanged, empty tables stay empty.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.llm.frames import packed

REMEMBERED = 128 << 20  # bytes of pieces and ids per generation and worker
ENTRY = 180  # bytes of an entry besides its characters and ids
KEPT = 256  # characters up to which a piece is remembered
LONG = 1 << 20  # characters from which a text is cut in blocks
FLUSH = 1 << 22  # ids per Arrow batch


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece, by a segment tree of pair ranks."""
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    bits = (n - 1).bit_length()
    size = 1 << bits
    mask = size - 1
    none = 1 << 62
    rank = ranks.get
    tree = [none] * (2 * size)
    for i in range(n - 1):
        r = rank(piece[i:i + 2])
        if r is not None:
            tree[size + i] = r << bits | i
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    after = list(range(1, n + 2))  # start of the next live token
    before = list(range(-1, n))  # start of the previous one
    while (least := tree[1]) < none:
        i = least & mask
        gone = after[i]
        end = after[i] = after[gone]
        before[end] = i
        changed = [(gone, none)]
        pair = rank(piece[i:after[end]]) if end < n else None
        changed.append((i, none if pair is None else pair << bits | i))
        if i:
            p = before[i]
            pair = rank(piece[p:end])
            changed.append((p, none if pair is None else pair << bits | p))
        for place, value in changed:
            node = size + place
            while node and tree[node] != value:
                tree[node] = value
                node >>= 1
                left, right = tree[2 * node], tree[2 * node + 1]
                value = left if left < right else right
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:after[i]]])
        i = after[i]
    return ids


class Pieces(dict):
    """Ids, as 32-bit numbers in bytes, by piece of text; a missing piece is merged and remembered.

    Two generations: when the younger is full it becomes the older one, so pieces in use stay known.
    """

    def __init__(self, ranks: dict[bytes, int], room: int = REMEMBERED):
        super().__init__()
        self.ranks, self.room, self.older, self.held = ranks, room, {}, 0

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            data = piece.encode()
            whole = self.ranks.get(data)
            ids = array("i", merge(data, self.ranks) if whole is None else (whole,)).tobytes()
        if len(piece) > KEPT:
            return ids
        self.held += ENTRY + 4 * len(piece) + len(ids)
        if self.held > self.room:
            self.older = dict(self)
            self.clear()
            self.held = ENTRY + 4 * len(piece) + len(ids)
        self[piece] = ids
        return ids


@lru_cache(maxsize=4)
def vocabulary(path: str) -> tuple[dict[bytes, int], list[bytes | None]]:
    """Ranks by token, and tokens by rank, of a rank file."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
    tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return ranks, tokens


@lru_cache(maxsize=4)
def _pieces(path: str) -> Pieces:
    return Pieces(vocabulary(path)[0])


def encode(text: str, known: Pieces, cut: regex.Pattern) -> bytes:
    """Ids of a whole text, as 32-bit numbers in bytes."""
    if len(text) < LONG:
        return b"".join(map(known.__getitem__, cut.findall(text)))
    found, ids = (m.group() for m in cut.finditer(text)), bytearray()
    while block := list(islice(found, 1 << 16)):
        ids += b"".join(map(known.__getitem__, block))
    return bytes(ids)


def _cut(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def encoded(df: DataFrame, path: str, pattern: str, text_column: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out``, the ids of the text, to all columns."""
    ids_type = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cut = _pieces(path), _cut(pattern)
        for batch in batches:
            texts = batch.column("_text")
            start, offsets, parts = 0, [0], []
            for i in range(len(texts)):
                parts.append(encode(texts[i].as_py(), known, cut))
                offsets.append(offsets[-1] + len(parts[-1]) // 4)
                if offsets[-1] >= FLUSH or i == len(texts) - 1:
                    values = pa.array(np.frombuffer(b"".join(parts), dtype=np.int32))
                    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, type=ids_type)
                    rows_done = batch.slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays([rows_done.column("_row"), lists], names=["_row", "_ids"])
                    start, offsets, parts = i + 1, [0], []

    rows = packed(df, _text=F.coalesce(F.col(text_column).cast("string"), F.lit("")))
    schema = T.StructType([rows.schema["_row"], T.StructField("_ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema).select("_row.*", F.col("_ids").alias(out))


def decoded(df: DataFrame, path: str, ids_column: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``, the bytes that the ids stand for, to all columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary(path)[1]

        def token(i: int) -> bytes:
            if not 0 <= i < len(tokens) or tokens[i] is None:
                raise ValueError(f"id {i} is not in the vocabulary")
            return tokens[i]

        whole = None not in tokens
        for batch in batches:
            lists = batch.column("_ids")
            made = []
            for i in range(len(lists)):
                ids = lists[i].values
                ids = np.empty(0, np.int32) if ids is None else ids.to_numpy(zero_copy_only=False)
                plain = whole and (not len(ids) or 0 <= ids.min() and ids.max() < len(tokens))
                made.append(b"".join(map(tokens.__getitem__ if plain else token, ids.tolist())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(made, pa.binary())], names=["_row", "_bytes"])

    rows = packed(df, _ids=F.col(ids_column).cast("array<int>"))
    schema = T.StructType([rows.schema["_row"], T.StructField("_bytes", T.BinaryType())])
    return rows.mapInArrow(run, schema).select("_row.*", F.col("_bytes").alias(out))

import random

import brute
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harborline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
KNOWN = brute.encoding(PATH, public_tokenizers.PATTERN)
RANKS = bpe.vocabulary(PATH)[0]


def encode(text, room=1000):
    known = bpe.Pieces(RANKS, room)
    return list(memoryview(bpe.encode(text, known, bpe._cut(public_tokenizers.PATTERN))).cast("i"))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    assert encode(text, room=3) == KNOWN.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=80))
def test_any_piece(data):
    assert bpe.merge(data, RANKS) == KNOWN._encode_bytes(data) or RANKS.get(data) is not None


@pytest.mark.parametrize("alphabet", ["ab", "a", "the ", "\n ", "éü漢"])
def test_long_pieces(alphabet):
    rng = random.Random(1)
    text = "".join(rng.choice(alphabet) for _ in range(20_000))
    assert encode(text) == KNOWN.encode_ordinary(text)


def test_long_text_in_blocks(monkeypatch):
    text = "some words, and more 123 " * 200
    monkeypatch.setattr(bpe, "LONG", 10)
    assert encode(text) == KNOWN.encode_ordinary(text)


def test_frames(docs, texts, monkeypatch):
    rows = [(i, t) for i, t, _ in texts] + [(-1, None), (-2, ""), (-3, "x" * 50_000), (-3, "x" * 50_000), (None, "<|endoftext|>")]
    df = docs(rows).withColumns({"_ids": F.lit(1), "_row": F.lit(2), "_text": F.lit(3)})
    both = bpe.decoded(bpe.encoded(df, PATH, public_tokenizers.PATTERN), PATH)
    assert both.columns == [*df.columns, "ids", "decoded"]
    got = both.select("text", "ids", "decoded").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == KNOWN.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encoded(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_unknown_ids_raise(spark):
    df = spark.createDataFrame([([1 << 20],)], "ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decoded(df, PATH).collect()
    assert bytes(bpe.decoded(spark.createDataFrame([(None,)], "ids array<int>"), PATH).first().decoded) == b""


def test_memory_is_bounded_in_bytes():
    """100 000 pieces of many lengths leave two generations of the stated size at most."""
    known, most = bpe.Pieces(dict.fromkeys((bytes([i]) for i in range(256)), 0), room=4 << 20), 0
    for i in range(100_000):
        piece = f"{i:07d}" + "x" * (i % 300)
        assert len(known[piece]) == 4 * len(piece) if i % 50 == 0 else known[piece]
        if i % 500 == 0:
            most = max(most, sum(4 * len(k) + len(v) for one in (known, known.older) for k, v in one.items()))
    assert 4 << 20 < most <= 2 * (4 << 20)
    assert all(len(k) <= bpe.KEPT for k in known)

import shutil

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from harborline.llm import tokencount as tc

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["a<|endoftext|>b", " <|ENDOFTEXT|> x", "a\x1cb", "a b  c", "é ́e", "İstanbul ΑΣ Σ", "", "  ", "\n\tq", "日本語 テキスト",
         "😀😀 x‍y", "\x85a", "x y", "don't DON'T 'S 12345 ½", "w" * 5000, "a b " * 5000, None, "a b  c", "a b c"]


def library(path):
    if path == PIECES:
        import sentencepiece

        return lambda t: len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t))
    made = Tokenizer.from_file(path)
    return lambda t: len(made.encode(t, add_special_tokens=False).ids)


@pytest.mark.parametrize("path", [WORDS, BYTES, PIECES])
def test_counts_equal_the_library(docs, path):
    count = library(path)
    df = docs(list(enumerate(TEXTS))).withColumns({"digest": F.lit(1), "content": F.lit(2), "n_tokens": F.lit(3)})
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tc.token_counts(df, path).collect()}
    assert got == {i: (len((t or "").encode()), count(t or ""), count(t or "") > 2048) for i, t in enumerate(TEXTS)}


def test_whole_table(docs, texts):
    count = library(WORDS)
    rows = [(i, t) for i, t, _ in texts]
    got = {r.doc_id: r.n_tokens for r in tc.token_counts(docs(rows), WORDS).collect()}
    assert got == {i: count(t) for i, t in rows}


def test_only_distinct_misses_are_encoded(docs, spark, tmp_path):
    cache = str(tmp_path / "cache")
    tc.token_counts(docs([(1, "one two"), (2, "one  two\n"), (3, "three")]), WORDS, cache).collect()
    stored = spark.read.parquet(cache)
    assert stored.count() == 2
    # A planted count proves that the stored one is used for known content.
    planted = stored.withColumn("n_tokens", F.lit(77).cast("bigint")).collect()
    shutil.copytree(cache, str(tmp_path / "second"))
    spark.createDataFrame(planted, tc.SCHEMA).write.mode("overwrite").parquet(str(tmp_path / "planted"))
    got = tc.token_counts(docs([(1, "one two"), (None, "four"), (5, "four")]), WORDS, str(tmp_path / "planted"))
    assert sorted((str(r.doc_id), r.n_tokens) for r in got.collect()) == [("1", 77), ("5", 1), ("None", 1)]
    assert spark.read.parquet(str(tmp_path / "planted")).count() == 3


def test_versions_do_not_mix(docs, tmp_path):
    cache, text = str(tmp_path / "cache"), "unmistakably tokenised"
    counts = [tc.token_counts(docs([(1, text)]), p, cache).first().n_tokens for p in (WORDS, BYTES, PIECES, WORDS)]
    assert counts == [library(p)(text) for p in (WORDS, BYTES, PIECES, WORDS)]
    assert len({tc.version(p) for p in (WORDS, BYTES, PIECES)}) == 3
    assert tc.drops_blanks(WORDS) and not tc.drops_blanks(BYTES) and not tc.drops_blanks(PIECES)


def test_empty(docs):
    assert tc.token_counts(docs([(1, "a")]).limit(0), WORDS).count() == 0


def test_memory_is_bounded_in_bytes():
    """100 000 runs of 3 KB, in texts of 50 runs, leave no more than the stated limit."""
    known, most = tc.Runs(lambda runs: [len(r) for r in runs], room=20 << 20), 0
    for text in range(2000):
        runs = [b"%d-%d-" % (text, i) + b"x" * 3000 for i in range(50)]
        assert known.total(runs * 2) == 2 * sum(map(len, runs))
        most = max(most, sum(map(len, known)))
    assert most <= 20 << 20

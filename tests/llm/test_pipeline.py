import math
from collections import Counter

import brute
import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from harborline.llm import catalog, quality
from harborline.llm.frames import tuned


def by_hand(rows, trusted):
    """The pipeline over (id, text, source) rows, stage by stage in plain Python."""
    scored = brute.quality([r[:2] for r in rows], trusted, quality.BUCKETS, quality.THRESHOLD)
    rows = [r for r, s in zip(rows, scored) if s[-1]]
    best = {}
    for r in rows:
        if r[1] not in best or r[0] > best[r[1]][0]:
            best[r[1]] = r
    rows = list(best.values())
    prints = {r[0]: brute.fingerprint(r[1]) for r in rows}
    group = brute.near_groups(prints.values())
    least = {}
    for r in sorted(rows):
        least.setdefault(group[prints[r[0]]], r)
    rows = list(least.values())
    encode = brute.encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).encode_ordinary
    return Counter({(r[0], tuple(encode(r[1]))): n for r, n in zip(rows, brute.mix(rows)) if n})


def test_against_brute_force(spark, folder, texts):
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    trusted = {r.doc_id for r in labels if r.quality == 1 and r.toxic == 0}
    got = Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, folder).collect())
    assert got == by_hand(texts, trusted)


def test_long_texts_pass(docs, folder):
    """A text of 300 000 different words goes through all stages whole."""
    text = " ".join(f"w{i}" for i in range(300_000))
    rows = docs([(1, text), (2, text), (3, "The quick brown fox jumps over the lazy dog near the river bank today")])
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(rows.sparkSession, rows, folder)
    found = {r.doc_id: r.n_tokens for r in rows.collect()}
    encode = brute.encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).encode_ordinary
    assert set(found) <= {2, 3} and found[2] == len(encode(text))


def test_stages_on_odd_tables(docs, folder):
    good = "The quick brown fox jumps over the lazy dog near the river bank today"
    df = docs([(1, None), (2, ""), (None, good), (4, good), (4, good), (5, good + " again"), (6, "é " * 40)])
    for i in (df, df.limit(0)):
        rows = i
        for name, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(df.sparkSession, rows, folder)
            assert rows.dtypes == df.dtypes, name
        out = corpus_pipeline.STAGES[-1][1](df.sparkSession, rows, folder)
        assert out.columns == ["doc_id", "source", "lang", "n_tokens", "ids"]
        assert out.count() == rows.count()


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES[:4]])
def test_extra_columns_pass(docs, folder, stage):
    good = "The quick brown fox jumps over the lazy dog near the river bank today"
    df = docs([(1, good), (2, good + " and so on")]).withColumns({"_key": F.lit(1), "hash": F.lit("x"), "a.b": F.lit(2)})
    out = dict(corpus_pipeline.STAGES)[stage](df.sparkSession, df, folder)
    assert out.columns == df.columns and out.count() <= math.ceil(3 * df.count())


def test_registered(spark):
    names = [n for n in __spark_entry__.queries() if n.startswith("op") or n == "pipeline"]
    assert {n.split("_")[0] for n in names} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mix", "encode"]


def test_query_columns(spark, folder):
    wanted = {
        "op1_warc": "page_id payload_bytes payload_digest record_type refers_to",
        "op2_language_id": "doc_id held_out lang_pred score",
        "op3_token_counts": "doc_id n_bytes n_tokens over_limit",
        "op4_simhash": "doc_id fingerprint component_id",
        "op6_mix_sources": "doc_id size source_size target taken",
        "op7_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op9_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op10_exact_dedup": "doc_id keep_id group_size kept text_sha256",
        "op11_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
        "op12_minhash": "doc_id n_shingles component_id kept",
        "op13_token_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    }
    for name, columns in wanted.items():
        assert set(columns.split()) <= set(catalog.QUERIES[name](tuned(spark), folder).columns), name

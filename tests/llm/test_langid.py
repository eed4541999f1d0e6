import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.llm import langid
from harborline.llm.frames import tuned


def test_letters():
    assert "".join(map(chr, langid.letters("  Ab,c 1\nÉ!"))) == " ab c é "
    assert len(langid.letters("12 ?\n")) == 0


def test_probabilities_sum_to_one():
    """After any context, seen or not, the characters of the alphabet and the unseen one share probability 1."""
    text = langid.letters("the cat sat on the mat and the dog sat on the log, that is all there is to it")
    windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([[32, 32], text]).astype(np.uint32), 4)
    rows, counts = np.unique(windows, axis=0, return_counts=True)
    model = langid.fit("x", rows, counts)
    alphabet = np.unique(windows[:, -1])
    for context in ("the", "at ", "zzz", " th", "q t"):
        head = np.array([ord(c) for c in context], dtype=np.uint32)
        chars = np.array([[*head, c] for c in [*alphabet, 0x4E00]], dtype=np.uint32)
        assert np.exp2(-langid.surprise(model, chars)).sum() == pytest.approx(1.0, abs=1e-9)


def test_batches_do_not_change_scores():
    text = langid.letters("one small text of the same kind")
    rows, counts = np.unique(np.lib.stride_tricks.sliding_window_view(text, 4), axis=0, return_counts=True)
    models = [langid.fit("x", rows, counts)]
    texts = [langid.letters(t) for t in ("one", "kind of text", "é", "same same same")]
    together = langid.entropies(models, texts)
    assert together == pytest.approx(np.vstack([langid.entropies(models, [t]) for t in texts]))


def test_held_out_accuracy(spark):
    """Shares the contract's split: what is measured was not learned from."""
    table = tuned(spark).read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identified_documents(table).join(table.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.rejected for r in held) / len(held) < 0.1


def test_edges(docs):
    rows = [(i, t) for i, t in enumerate(["some words here"] * 12)]
    df = docs([*rows, (50, None), (51, ""), (52, "12 !"), (53, "é"), (None, "words"), (53, "é"), (54, "word " * 30_000)])
    df = df.withColumns({"score": F.lit(9), "_lang": F.lit(8)}).withColumn(
        "lang", F.when(F.col("doc_id") % 2 == 0, "aa").when(F.col("doc_id") < 11, "bb"))
    got = {(r.doc_id, r.lang_pred == "und") for r in langid.identified_documents(df).collect()}
    assert {i for i, und in got if und} == {50, 51, 52}
    assert langid.identified_documents(df).count() == 19
    assert langid.identified_documents(df.limit(0)).count() == 0
    unlabelled = langid.identified_documents(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}


def test_foreign_text_is_rejected(spark):
    table = tuned(spark).read.parquet("/root/testdata/sf0.01/documents.parquet")
    models = langid.train(table.filter("doc_id % 2 = 0"), table.filter("doc_id % 2 = 1"), ["doc_id"])
    strange = spark.createDataFrame([("привет как дела сегодня " * 20,), ("zqxj kwvv xxqz " * 30,)], "text string")
    assert all(r.rejected for r in langid.identify(strange, models).collect())


def test_long_texts_are_learned(docs):
    """A language of long texts has a model and a limit; of each text a bounded part is counted."""
    rows = [(i, ("der hund und die katze " if i % 2 else "the dog and a cat ") * (2000 if i % 2 else 3)) for i in range(40)]
    df = docs(rows).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "de").otherwise("en"))
    got = langid.identified_documents(df).collect()
    assert all(r.lang_pred == ("de" if r.doc_id % 2 else "en") for r in got)
    models = langid.train(df.filter("doc_id < 20"), df.filter("doc_id >= 20"), ["doc_id"])
    assert [m.name for m in models] == ["de", "en"] and all(np.isfinite(m.limit) for m in models)
    only = df.filter("lang = 'de'")
    assert {r.lang_pred for r in langid.identified_documents(only).collect()} == {"de"}


def test_pieces():
    points = np.arange(100_001, dtype=np.uint32)
    parts = langid._pieces(points, -5)
    assert [len(p) for p in parts] == [5000] * 4 and all((np.diff(p) == 1).all() for p in parts)
    assert all(k * 25_000 <= p[0] and p[-1] < (k + 1) * 25_000 for k, p in enumerate(parts))
    assert [p[0] for p in langid._pieces(points, -5)] == [p[0] for p in parts] != [p[0] for p in langid._pieces(points, 6)]
    assert langid._pieces(points[:20_000], 1)[0] is not None and len(langid._pieces(points[:20_000], 1)) == 1


def test_stray_languages_leave_the_sample_to_the_others(spark, docs):
    sizes = spark.createDataFrame([("en", 10**6), ("de", 10**6), *[(f"x{i}", 1) for i in range(1500)]], "lang string, n long")
    assert langid._share(sizes, "n", 1500) == 1500
    assert langid._share(sizes, "n", 10**6) == (langid.SAMPLE_ROWS - 1500) // 2
    assert langid._share(spark.range(langid.SAMPLE_ROWS * 2).select(F.lit(5).alias("n")), "n", 1500) == 1
    assert langid._share(sizes.limit(0), "n", 1500) == 1500


def test_more_than_a_thousand_languages(docs):
    rows = [(i, f"word{chr(97 + i % 26)}") for i in range(1100)] + [(i, "the dog and a cat") for i in range(2000, 2040)]
    df = docs(rows).withColumn("lang", F.when(F.col("doc_id") < 1100, F.concat(F.lit("x"), "doc_id")).otherwise("en"))
    models = langid.train(df, df.limit(0), ["doc_id"])
    assert len(models) == 1101


def test_language_of_the_calibrating_part_alone(docs):
    df = docs([(i, "der hund" if i < 5 else "the cat and") for i in range(30)])
    df = df.withColumn("lang", F.when(F.col("doc_id") < 5, "de").otherwise("en"))
    models = langid.train(df.filter("doc_id >= 10"), df.filter("doc_id < 10"), ["doc_id"])
    assert [(m.name, np.isfinite(m.limit)) for m in models] == [("de", False), ("en", True)]


def naive(text, order=4):
    """Probability of a character after others, by the definition, with dictionaries of strings."""
    counts = {order: {}}
    for i in range(len(text) - order + 1):
        g = text[i:i + order]
        counts[order][g] = counts[order].get(g, 0) + 1
    for k in range(order - 1, 0, -1):
        before = {}
        for g in counts[k + 1]:
            before.setdefault(g[1:], set()).add(g[0])
        counts[k] = {g: len(x) for g, x in before.items()}
    alphabet = len(counts[1]) + 1

    def discount(k):
        once, twice = (sum(n == m for n in counts[k].values()) for m in (1, 2))
        return once / (once + 2 * twice) if once and twice else 0.5

    def chance(context, char, k=order):
        if k == 0:
            return 1 / alphabet
        head = context[len(context) - k + 1:] if k > 1 else ""
        after = {g[-1]: n for g, n in counts[k].items() if g[:-1] == head}
        lower = chance(context, char, k - 1)
        if not after:
            return lower
        d, total = discount(k), sum(after.values())
        return max(after.get(char, 0) - d, 0) / total + d * len(after) / total * lower

    return chance


def test_against_a_naive_model():
    text = " " * 3 + "the cat sat on the mat and that dog ate the other hat as they said at noon "
    points = np.array([ord(c) for c in text], dtype=np.uint32)
    rows, counts = np.unique(np.lib.stride_tricks.sliding_window_view(points, 4), axis=0, return_counts=True)
    model, chance = langid.fit("x", rows, counts), naive(text)
    for context in ("the", " th", "at ", "zzz", "hqz", "q a", "oth"):
        for char in "aehnot qé":
            window = np.array([[ord(c) for c in context + char]], dtype=np.uint32)
            assert np.exp2(-langid.surprise(model, window))[0] == pytest.approx(chance(context, char), rel=1e-9), (context, char)


def test_models_are_bounded_for_any_alphabet(docs, monkeypatch):
    """Texts of random characters give a new n-gram at every place; the frequent ones of each language are kept."""
    rng = np.random.default_rng(1)
    rare = ["".join(map(chr, rng.integers(0x4E00, 0x5E00, 3000))) for _ in range(10)]
    known = "般若波羅蜜多心経観自在菩薩"
    rows = [(2 * i, text + known * 20) for i, text in enumerate(rare)] + [(2 * i + 1, "der hund und die katze ") for i in range(10)]
    df = docs(rows).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "de").otherwise("zz"))
    whole = langid.train(df, df.limit(0), ["doc_id"])
    assert [len(m.grams[-1][0]) > 20_000 for m in whole] == [False, True]
    monkeypatch.setattr(langid, "GRAMS", 2000)
    models = langid.train(df, df.limit(0), ["doc_id"])
    sizes = [len(m.grams[-1][0]) for m in models]
    assert sizes[0] == len(whole[0].grams[-1][0]) and 1500 < sum(sizes) < 2200
    repeated = langid.letters(known * 3)[1:-1]
    assert np.isin(langid.grams(repeated, 4), models[1].grams[-1][0]).all()
    got = langid.identify(df, models).collect()
    assert all(r.lang_pred == r.lang for r in got)
    again = langid.train(df.repartition(7), df.limit(0), ["doc_id"])
    assert all((a.grams[-1][0] == b.grams[-1][0]).all() for a, b in zip(models, again))


def test_the_empty_string_is_a_language(docs):
    df = docs([(i, "der hund und die katze" if i % 2 else "the cat and a dog") for i in range(40)])
    df = df.withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "de").otherwise(""))
    got = langid.identified_documents(df).collect()
    assert all(r.lang_pred == ("de" if r.doc_id % 2 else "") for r in got)

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harborline.llm import quality
from harborline.llm.frames import tuned

COLUMNS = ["doc_id", *quality.BASE, "base_failed", "kept"]


@pytest.fixture()
def labels(spark):
    return lambda rows: tuned(spark).createDataFrame(rows, "doc_id long, quality int, toxic int")


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_against_brute_force(docs, labels, texts, spark, folder):
    table = spark.read.parquet(f"{folder}/labels.parquet")
    trusted = {r.doc_id for r in table.collect() if r.quality == 1 and r.toxic == 0}
    rows = [(i, t) for i, t, _ in texts]
    got = rows_of(quality.quality(docs(rows), table))
    assert got == sorted(brute.quality(rows, trusted, quality.BUCKETS, quality.THRESHOLD), key=str)
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_edges(docs, labels):
    line = "one two three four five six seven eight nine ten"
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, line), (4, line), (None, line), (5, f"{line}\n{line}\n \n \n"),
            (6, "a a a a a a a a a a a"), (7, "# * | <x> $%&"), (8, "é ü \x0b\x0c q"), (9, "w " * 5000)]
    given_labels = labels([(4, 1, 0), (4, 1, 0), (None, 1, 0), (6, 1, 1), (7, None, None)])
    df = docs(rows).withColumns({"one": F.lit(1), "bucket": F.lit(2), "_w": F.lit(3), "rows": F.lit(4)})
    assert rows_of(quality.quality(df, given_labels)) == sorted(
        brute.quality(rows, {4}, quality.BUCKETS, quality.THRESHOLD), key=str)
    kept = quality.keep_good(df, given_labels)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(r[0]) for r in brute.quality(rows, {4}, quality.BUCKETS, quality.THRESHOLD) if r[-1])


def test_empty_and_unlabelled(docs, labels):
    assert quality.quality(docs([(1, "a")]).limit(0), labels([(1, 1, 0)])).count() == 0
    text = "one two three four five six seven eight nine ten"
    assert [r.kept for r in quality.quality(docs([(1, text)]), labels([]).limit(0)).collect()] == [True]


def test_repeated_labels_change_nothing(docs, labels, texts):
    ids = [(i, 1, 0) for i in range(4000)]
    once = {r._id for r in quality.trusted_ids(labels(ids), 1000).collect()}
    assert 800 < len(once) < 1200
    assert once == {r._id for r in quality.trusted_ids(labels(ids * 10 + ids[:500] * 7), 1000).collect()}
    rows = [(i, t) for i, t, _ in texts]
    marks = [(i, i % 2, 0) for i, _, _ in texts]
    first, again = (rows_of(quality.quality(docs(rows), labels(m))) for m in (marks, marks * 3 + marks[:90] * 5))
    assert first == again


@settings(max_examples=3, deadline=None)
@given(data=st.lists(st.text(alphabet="ab \n\t#é", max_size=120), min_size=20, max_size=60))
def test_base_counts(spark, data):
    df = tuned(spark).createDataFrame(list(enumerate(data)), "id long, t string")
    got = quality.base_columns(df, "t", ["id"]).drop("_w").orderBy("id").collect()
    assert [tuple(r)[1:] for r in got] == [brute.base(t) for t in data]


def test_no_python_on_the_main_path(docs, labels):
    plan = quality.quality(docs([(1, "a b")]), labels([(1, 1, 0)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("table", ["sf0.001", "sf0.01"])
def test_plain_documents_stay_and_junk_goes(spark, table):
    """Also in a small corpus with few labels, where most n-grams occur once; filters on the result are cheap."""
    folder = f"/root/testdata/{table}"
    docs, given = (tuned(spark).read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    got = quality.quality(docs, given).filter("NOT base_failed")
    marks = F.col("n_symbols") / F.col("n_words")
    assert got.filter((marks < 0.05) & ~F.col("kept")).count() == 0
    junk = got.filter(marks > 0.5)
    assert junk.filter("NOT kept").count() > 0.8 * junk.count() > 0

from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from harborline.llm import mixing

ROWS = [(i, "w " * (i % 7 + 1), "abc"[i % 3]) for i in range(60)] + [
    (100, "many " * 500, "big"), (101, None, "empty"), (102, " \t\n", None), (None, "one", None), (103, "é x", "ü"),
    (100, "many " * 500, "big")]


def test_against_brute_force(docs):
    got = mixing.mix_plan(docs(ROWS)).collect()
    sizes = Counter()
    for _, text, source in ROWS:
        sizes[source] += len(brute.words(text))
    targets = brute.targets(sizes)
    expected = sorted((str(r[0]), len(brute.words(r[1])), sizes[r[2]], targets[r[2]], c) for r, c in zip(ROWS, brute.mix(ROWS)))
    rows = sorted((str(r.doc_id), r["size"], r.source_size, r.target, r.copies) for r in got)
    assert [r[:3] + r[4:] for r in rows] == [e[:3] + e[4:] for e in expected]
    assert [r[3] for r in rows] == pytest.approx([e[3] for e in expected], rel=1e-12)
    assert all(r.taken == r["size"] * r.copies <= 3 * r["size"] for r in got)
    assert sum({s: t for s, t in targets.items()}.values()) == pytest.approx(sum(sizes.values()))


def test_same_for_any_partitioning(docs):
    one, many = (sorted(map(str, mixing.mix_plan(docs(ROWS, n)).collect())) for n in (1, 9))
    assert one == many


def test_documents_are_repeated(docs):
    df = docs(ROWS).withColumns({"copies": F.lit("x"), "size": F.lit("y"), "target": F.lit("z"), "_source": F.lit("q")})
    out = mixing.mixed(df)
    assert out.columns == df.columns
    expected = Counter()
    for row, n in zip(ROWS, brute.mix(ROWS)):
        expected[row[0]] += n
    assert Counter(r.doc_id for r in out.collect()) == +expected


def test_taken_is_near_the_target(spark, folder):
    plan = mixing.mix_plan(spark.read.parquet(f"{folder}/documents.parquet"))
    total = plan.agg(F.sum("taken"), F.sum("size")).first()
    assert abs(total[0] / total[1] - 1) < 0.3


def test_empty_and_wordless(docs):
    assert mixing.mix_plan(docs([(1, "a")]).limit(0)).count() == 0
    assert [r.taken for r in mixing.mix_plan(docs([(1, ""), (2, None)])).collect()] == [0, 0]
    assert mixing.mixed(docs([(1, "")])).count() == 0


def test_long_texts(docs):
    rows = [(1, "word " * 400_000, "a"), (2, "one two", "b"), (3, " \n" * 300_000 + "end", "b")]
    got = {r.doc_id: r["size"] for r in mixing.mix_plan(docs(rows)).collect()}
    assert got == {1: 400_000, 2: 2, 3: 1}

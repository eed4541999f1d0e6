import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.llm import catalog, rtree
from harborline.llm.frames import tuned

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, every=100, positives=5, negatives=10, low=30, high=90, relabel=False):
    """All products, sorted."""
    used = []
    for id_, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if relabel and id_ is not None and id_ % 7 == 0 else label
        used.append((id_, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for i, (id_, v, label) in enumerate(used):
        if id_ is None or id_ % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), other, k == label) for j, (other, w, k) in enumerate(used)
                  if j != i and len(w) == len(v)]
        for p, pid, _ in sorted((x for x in scored if x[2]), key=order)[:positives]:
            inside = [x for x in scored if not x[2] and low * p <= 100 * x[0] <= high * p]
            out += [(id_, pid, r + 1, nid, p, n) for r, (n, nid, _) in enumerate(sorted(inside, key=order)[:negatives])]
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture()
def frame(spark):
    return lambda rows, parts=3: tuned(spark).createDataFrame(rows, SCHEMA).repartition(parts)


def vectors(seed, count, dim, labels=3, spread=1.0):
    draw = np.random.default_rng(seed)
    found = draw.normal(size=(count, dim)) * spread + draw.normal(size=dim)
    return [(i, [float(np.float32(x)) for x in v], int(draw.integers(labels))) for i, v in enumerate(found)]


@pytest.mark.parametrize("dim, page, parts, block", [(2, 8, 2, 2), (6, 16, 3, 256), (64, 512, 128, 3)])
def test_against_all_products(frame, dim, page, parts, block):
    rows = vectors(dim, 400, dim)
    found = rtree.hard_negatives(frame(rows), every=20, page=page, per_subtree=parts, block=block)
    assert result(found) == plain(rows, every=20)


def test_query_against_all_products(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = catalog.QUERIES["op11_hard_negatives"](spark, folder)
    assert found.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
                            ("positive_score", "bigint"), ("negative_score", "bigint")]
    assert result(found) == plain(rows, relabel=True)


def test_ties_and_copies(frame):
    """A vector that many rows share, and scores that many rows have."""
    draw = np.random.default_rng(2)
    rows = [(i, [float(x) for x in draw.integers(-2, 3, 3) / 4], int(i % 2)) for i in range(150)]
    rows += [(200 + i, [0.5, 0.25, 0.5], i % 3) for i in range(120)]
    found = rtree.hard_negatives(frame(rows), every=25, page=10, per_subtree=2)
    assert result(found) == plain(rows, every=25)


def test_rows_that_take_no_part(frame):
    rows = vectors(4, 60, 3)
    rows += [(100, None, 1), (200, [1.0, None, 2.0], 1), (300, [1.0, float("nan"), 0.0], 0), (400, [float("inf"), 0.0, 0.0], 0),
             (500, [1.0, 1.0, 1.0], None), (600, [1.0, 1.0], 1), (700, [], 2), (800, [], 2), (801, [0.5, 1.0], 1),
             (802, [0.25, 0.5], 0), (None, [1.0, 0.5, 0.2], 0), (None, [0.5, 1.0, 0.1], 1)]
    assert result(rtree.hard_negatives(frame(rows), page=8)) == plain(rows)


def test_repeated_rows(frame):
    rows = [(100, [1.0, 0.0], 0)] * 2 + [(101, [0.9, 0.1], 0), (7, [0.5, 0.5], 1), (7, [0.5, 0.5], 1)]
    assert result(rtree.hard_negatives(frame(rows))) == plain(rows)


def test_empty_and_other_columns(frame):
    assert rtree.hard_negatives(frame([])).count() == 0
    rows = vectors(9, 80, 4)
    extra = frame(rows).withColumns({"number": F.lit("x"), "page": F.lit(1), "v": F.lit(2), "score": F.lit(None).cast("int")})
    assert result(rtree.hard_negatives(extra, every=10)) == plain(rows, every=10)


def test_large_components(frame):
    """Products beyond the exact range of doubles, and beyond 64-bit sums of squares."""
    for spread in (3e5, 2e6):
        rows = vectors(11, 50, 4, spread=spread)
        assert result(rtree.hard_negatives(frame(rows), every=10)) == plain(rows, every=10)


def test_negative_and_zero_positives(frame):
    rows = [(0, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, [0.0, -1.0], 1), (4, [-0.5, 0.0], 1)]
    assert result(rtree.hard_negatives(frame(rows))) == plain(rows)


def test_boxes_bound_their_pages():
    draw = np.random.default_rng(8)
    page = lambda: (draw.integers(-9, 9, (5, 3)).astype(float), np.arange(5), np.arange(5), np.zeros(5))
    tree = rtree.packed_tree([page() for _ in range(20)], fanout=3)
    anchor = draw.integers(-9, 9, 3).astype(float)
    least, most = rtree.bounds(tree, anchor)
    for i, v in enumerate(tree.vectors):
        scores = v @ anchor
        assert least[i] <= scores.min() and scores.max() <= most[i]
    for i, own in enumerate(tree.children):
        assert most[20 + i] >= max(most[c] for c in own) and least[20 + i] <= min(least[c] for c in own)

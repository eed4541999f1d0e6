"""Key sets as bitmaps, against plain sets."""

import random

import pytest

from harborline.operators import keysets


def test_numbers(spark):
    rng = random.Random(6)
    keys = [rng.choice([-1, 1]) * rng.randrange(10 ** rng.randrange(1, 16)) for _ in range(3000)] + [0, 32768, 32769, -32768, None]
    probes = keys[::3] + [k + 1 for k in keys if k is not None][::2] + [None, 2 ** 62, -(2 ** 62)]
    left = spark.createDataFrame(list(enumerate(probes)), "i int, k long").repartition(3)
    right = spark.createDataFrame([(k,) for k in keys + keys[:50]], "key long")
    got = {r["i"]: r["m"] for r in keysets.with_membership(left, "k", right, "key", "m").collect()}
    known = {k for k in keys if k is not None}
    assert got == {i: k in known for i, k in enumerate(probes)}


def test_texts(spark):
    keys = ["1", "01", "-5", "12345678901234567890", "A-1", "", " 7", "7", "0", "-0", None]
    probes = keys + ["5", "+1", "1 ", "007", "a-1", "123456789012345678", "-1"]
    left = spark.createDataFrame(list(enumerate(probes)), "i int, k string")
    right = spark.createDataFrame([(k,) for k in keys], "key string")
    got = {r["i"]: r["m"] for r in keysets.with_membership(left, "k", right, "key", "m").collect()}
    known = {k for k in keys if k is not None}
    assert got == {i: k in known for i, k in enumerate(probes)}
    lost = keysets.orphans(left, "k", right, "key")
    assert lost.columns == ["i", "k"] and {r["k"] for r in lost.collect()} == set(probes) - {None} - known


def test_empty_sets_and_kinds(spark):
    left, none = spark.createDataFrame([(1,), (None,)], "k long"), spark.createDataFrame([], "key long")
    assert [r["m"] for r in keysets.with_membership(left, "k", none, "key", "m").collect()] == [False, False]
    assert keysets.with_membership(left.limit(0), "k", none, "key", "m").count() == 0
    with pytest.raises(ValueError, match="kinds"):
        keysets.with_membership(left, "k", spark.createDataFrame([], "key string"), "key", "m")


def test_rows_are_marked_where_they_lie(spark):
    """The set of a hundred thousand keys is small enough to be sent to the rows."""
    left, right = spark.range(1000).withColumnRenamed("id", "k"), spark.range(100_000).withColumnRenamed("id", "key")
    plan = keysets.with_membership(left, "k", right, "key", "m")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan

"""Published versions, derived tables, the audit log and the catalog."""

import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from harborline.operators.ordering import grouped_quantiles
from harborline.sources import commits, sinks


def test_a_mismatch_leaves_the_published_version(spark, frame, tmp_path):
    target = str(tmp_path / "p")
    first, second = frame("x int", [(1,), (2,)]), frame("x int", [(3,)])
    assert sinks.publish({"a": first}, target, {"a": 2}) == {"a": 2}
    with pytest.raises(RuntimeError, match="a has 1 instead of 2"):
        sinks.publish({"a": second}, target, {"a": 2})
    assert commits.last_commit(spark, target) == 1
    assert sinks.read_published(spark, target)["a"].count() == 2


def test_readers_keep_their_version(spark, frame, tmp_path):
    target = str(tmp_path / "p")
    for n in (1, 2, 3):
        sinks.publish({"a": frame("x int", [(i,) for i in range(n)]), "b": frame("y string", [])}, target, None)
    assert [sinks.read_published(spark, target, v)["a"].count() for v in (1, 2, 3)] == [1, 2, 3]
    assert sinks.read_published(spark, target)["a"].count() == 3
    with pytest.raises(ValueError, match="no commit"):
        sinks.read_published(spark, target, 9)
    with pytest.raises(ValueError, match="no commit"):
        sinks.read_published(spark, str(tmp_path / "nothing"))


def test_one_of_two_publishers_wins(spark, frame, tmp_path):
    """Both start from version 1 and write; the second to commit is told so, and loses nothing of the first."""
    target = str(tmp_path / "p")
    sinks.publish({"a": frame("x int", [(0,)])}, target, None)
    frames = [frame("x int", [(i,)] * (i + 2)) for i in range(2)]
    outcomes, gate = {}, threading.Barrier(2)

    def publisher(i):
        gate.wait()
        try:
            outcomes[i] = sinks.publish({"a": frames[i]}, target, None, based_on=1)
        except commits.Conflict as error:
            outcomes[i] = error

    threads = [threading.Thread(target=publisher, args=(i,)) for i in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    (winner,) = [i for i, o in outcomes.items() if isinstance(o, dict)]
    assert isinstance(outcomes[1 - winner], commits.Conflict)
    assert commits.last_commit(spark, target) == 2
    assert sinks.read_published(spark, target)["a"].count() == winner + 2
    assert sinks.publish({"a": frames[0]}, target, None) == {"a": 2} and commits.last_commit(spark, target) == 3


def test_a_number_is_taken_once(spark, tmp_path):
    folder = str(tmp_path / "log")
    commits.commit(spark, folder, 1, {"a": 1})
    with pytest.raises(commits.Conflict):
        commits.commit(spark, folder, 1, {"a": 2})
    assert commits.read_commit(spark, folder, 1) == {"a": 1}
    assert sorted(p.name for p in (tmp_path / "log" / "_commits").iterdir() if p.suffix == ".json") == ["000000000001.json"]


def test_the_old_derived_table_stays_until_the_new_one_is_whole(spark, frame, tmp_path):
    path = str(tmp_path / "derived")
    assert sinks.replace_derived(frame("x int", [(1,), (2,)]), path) == 2
    broken = frame("x int", [(5,), (6,)]).select(F.when(F.col("x") == 6, F.raise_error(F.lit("lost"))).otherwise(F.col("x")).cast("int").alias("x"))
    with pytest.raises(Exception, match="lost"):
        sinks.replace_derived(broken, path)
    assert sorted(r.x for r in sinks.read_derived(spark, path).collect()) == [1, 2]
    # A table may be replaced by a version of itself.
    assert sinks.replace_derived(sinks.read_derived(spark, path).filter("x > 1"), path) == 1
    assert [r.x for r in sinks.read_derived(spark, path).collect()] == [2]
    assert sinks.read_derived(spark, path, 1).count() == 2


def test_catalog_scan_prunes_and_pushes(spark, tmp_path):
    target = str(tmp_path / "p")
    df = spark.range(1000).selectExpr("id", "id % 10 AS amount", "concat('2024-0', id % 4 + 1) AS month")
    sinks.publish({"facts": df}, target, {"facts": 1000}, partitions={"facts": ["month"]})
    (name,) = sinks.register_published(spark, target, prefix="t_")
    found = sinks.scan(spark, name, ["id"], (F.col("month") == "2024-02") & (F.col("amount") == 3))
    assert sorted(r.id for r in found.collect()) == [i for i in range(1000) if i % 4 == 1 and i % 10 == 3]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "EqualTo(amount,3)" in plan
    assert "ReadSchema: struct<id:bigint,amount:bigint>" in plan
    assert "InMemoryFileIndex(1 paths)" in plan or "PartitionCount: 1" in plan or "CatalogFileIndex" in plan
    sinks.publish({"facts": df.limit(0)}, target, {"facts": 0}, partitions={"facts": ["month"]})
    sinks.register_published(spark, target, prefix="t_")
    assert spark.table(name).count() == 0 and sinks.read_published(spark, target)["facts"].columns == ["id", "amount", "month"]
    spark.sql(f"DROP TABLE {name}")


START = datetime(2026, 1, 1)


def entries(spark, rows):
    full = [(run, step, status, START + timedelta(minutes=at), START + timedelta(minutes=at), at, "") for run, step, status, at in rows]
    return spark.createDataFrame(full, sinks.AUDIT)


def test_audit_state_follows_the_appends(spark, tmp_path):
    """Equal to the state recomputed from all entries after every append; late entries do not win."""
    path = str(tmp_path / "audit")
    rows = [(f"r{i % 7}", f"s{i % 3}", "completed" if i % 2 else "running", (i * 37) % 101) for i in range(60)]
    for n, part in enumerate((rows[:25], rows[25:26], rows[26:]), start=1):
        assert sinks.append_audit(entries(spark, part), path) == n
        kept = sinks.audit_state(spark, path)
        again = sinks.latest_audit(sinks.read_audit(spark, path))
        assert sorted(map(tuple, kept.drop("entries").collect())) == sorted(map(tuple, again.collect()))
    assert sum(r.entries for r in sinks.audit_state(spark, path).collect()) == 60
    assert sinks.read_audit(spark, path).count() == 60
    assert sinks.audit_state(spark, path, 1).agg(F.sum("entries")).first()[0] == 25


def test_an_append_writes_only_the_buckets_it_touches(spark, tmp_path):
    path = tmp_path / "audit"
    sinks.append_audit(entries(spark, [(f"r{i}", "load", "running", i) for i in range(200)]), str(path))
    before = commits.read_commit(spark, str(path), 1)["buckets"]
    sinks.append_audit(entries(spark, [("r5", "load", "completed", 500)]), str(path))
    after = commits.read_commit(spark, str(path), 2)["buckets"]
    changed = [b for b in after if after[b] != before[b]]
    assert len(before) > 32 and len(changed) == 1
    written = {p.name for p in (path / after[changed[0]]).iterdir() if p.is_dir()}
    assert written == {f"part={changed[0]}"}
    row = sinks.audit_state(spark, str(path)).filter("run_id = 'r5'").first()
    assert (row.status, row.entries) == ("completed", 2)


def test_appends_that_meet_are_merged(spark, tmp_path):
    path, done = str(tmp_path / "audit"), []
    parts = [entries(spark, [("r1", "s", "running", i), (f"q{i}", "s", "running", i)]) for i in range(3)]
    threads = [threading.Thread(target=lambda df=df: done.append(sinks.append_audit(df, path))) for df in parts]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(done) == [1, 2, 3]
    assert {r.run_id: r.entries for r in sinks.audit_state(spark, path).collect()} == {"r1": 3, "q0": 1, "q1": 1, "q2": 1}


@pytest.mark.parametrize("parts", ["1", "5"])
def test_grouped_quantiles(spark, parts):
    import random

    import numpy as np

    rng, shares = random.Random(4), {"a": 0.0, "b": 0.1, "c": 0.5, "d": 1.0}
    rows = [(rng.choice(["x", "y", None]), round(rng.gauss(0, 5), 1)) for _ in range(500)] + [("lone", 2.0), ("none", None), ("x", None)]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    got = {r["g"]: tuple(r)[1:] for r in grouped_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", shares).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got.pop("none") == (None,) * 4
    for group, found in got.items():
        values = [v for g, v in rows if g == group and v is not None]
        assert found == pytest.approx([np.quantile(values, p) for p in shares.values()], abs=1e-9)
    assert set(got) == {"x", "y", None, "lone"}

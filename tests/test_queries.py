"""Registered queries: contract of the entry module and shape of the plans."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from harborline.plans import decompose, features, kpi
from harborline.sources.tables import OpsTables

ROOT = Path(__file__).resolve().parents[1]
FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_registry_loads_without_a_session():
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()); print(len(e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) > 190


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["month", "total_orders", "fulfilled_orders", "fulfilment_rate", "mom_change"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["j01_fulfilment_rate", "j12_monthly_kpis", "k20_chi_square", "l03_contribution", "g05_ntile"])
def test_result_does_not_depend_on_partitions(spark, name):
    results = []
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        rows = entry_module.queries()[name](spark, FOLDER).collect()
        results.append(sorted(map(str, rows)))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


def test_filters_and_columns_reach_the_scan(spark):
    from harborline.functions.dates import in_month

    ops = OpsTables(spark, FOLDER)
    text = plan(ops["order_headers"].filter(in_month("order_date", "2000-02")).select("order_id"))
    pushed = text.split("PushedFilters")[1]
    assert "GreaterThanOrEqual(o_orderdate,2000-02-01T00:00)" in pushed and "LessThan(o_orderdate,2" in pushed
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_facts_are_never_sorted_in_one_task(spark):
    """Single-partition exchanges only carry partial aggregates or results of a grouping."""
    ops = OpsTables(spark, FOLDER)
    for df in (kpi.orders_enriched(ops), kpi.customer_rfm_base(ops), kpi.inventory_turnover(ops),
               decompose.order_facts(ops), features.order_features(ops)):
        lines = plan(df).split("\n")
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                assert "HashAggregate(keys=[]" in lines[i + 1], line


def test_no_python_outside_the_forest(spark):
    ops = OpsTables(spark, FOLDER)
    for df in (kpi.orders_enriched(ops), kpi.supplier_delay(ops), decompose.order_facts(ops), features.order_features(ops)):
        assert "Python" not in plan(df) and "Arrow" not in plan(df)


def test_supplier_mean_reuses_the_counts(spark):
    df = kpi.supplier_performance(OpsTables(spark, FOLDER))
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_bucketed_facts_meet_without_a_shuffle(spark, tmp_path):
    from harborline.operators.joins import fact_join
    from harborline.sources.facts import BucketedFacts

    ops = OpsTables(spark, FOLDER)
    facts = BucketedFacts(ops, str(tmp_path / "facts"), 3)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = fact_join(facts["order_headers"], facts["order_lines"], "order_id")
        for df in (joined, kpi.orders_enriched(facts), kpi.inventory_turnover(facts), decompose.order_facts(facts)):
            assert "hashpartitioning(order_id" not in plan(df)
        assert "hashpartitioning(order_id" in plan(kpi.orders_enriched(ops))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted(map(tuple, kpi.orders_enriched(facts).collect())) == sorted(map(tuple, kpi.orders_enriched(ops).collect()))
    assert len(list((tmp_path / "facts" / "orders").glob("part-*"))) == 3

"""Scans, sinks, publishing, exports and the audit log.

Files are written below the session's shared folder and read back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.catalog import analytics, cleaning, decomposition, kpis  # noqa: F401  (kpis registers SQL used here)
from harborline.catalog.ctes import with_ctes
from harborline.catalog.registry import ORACLES, query, rounded
from harborline.contract import CONTRACT
from harborline.functions.dates import in_month
from harborline.operators import clean, validate
from harborline.operators.joins import fact_join
from harborline.operators.storage import shared_path, staged
from harborline.plans import decompose, features, kpi, segments
from harborline.sources import bundle, sinks
from harborline.sources.calendar import calendar_of
from harborline.sources.facts import BucketedFacts
from harborline.sources.raw import RawTables

VIEWS = {
    "vw_orders_enriched": kpi.orders_enriched,
    "vw_monthly_kpis": kpi.monthly_kpis,
    "vw_warehouse_performance": kpi.warehouse_performance,
    "vw_supplier_performance": kpi.supplier_performance,
    "vw_inventory_status": kpi.inventory_status,
    "vw_customer_rfm": kpi.customer_rfm_view,
}


def written_as_csv(df: DataFrame, name: str, order: str) -> tuple[str, str]:
    """Write a frame as a sorted CSV folder; the bundle folder and the table path."""
    folder = shared_path(df.sparkSession, "bundle")
    ordered = df.repartitionByRange(order).sortWithinPartitions(order).drop(order)
    bundle.write_csv(ordered, f"{folder}/{name}.csv")
    return folder, f"{folder}/{name}.csv"


@query("a01_csv_scan", with_ctes("SELECT * FROM raw_orders"))
def csv_scan(ops):
    """A raw table written as CSV and read back through the bundle reader."""
    folder, _ = written_as_csv(RawTables(ops)["orders"], "orders", "source_row")
    return bundle.read_bundle(ops.spark, folder)["orders"]


BROKEN_NOTES = """
SELECT source_row, order_id, customer_id, warehouse_id, employee_id, order_date,
       CASE CAST(source_row AS BIGINT) % 5
            WHEN 0 THEN 'first' || chr(10) || '"second", ' || employee_id || chr(10) || chr(10) || 'last'
            WHEN 1 THEN 'said ""' || chr(13) || chr(10) || order_status WHEN 2 THEN '"' ELSE order_notes END AS order_notes,
       order_status FROM raw_orders"""


@query("a01_csv_scan_with_breaks", with_ctes(BROKEN_NOTES))
def csv_scan_with_breaks(ops):
    """A raw table whose notes hold line breaks and quotes, read back in parallel."""
    orders = RawTables(ops)["orders"]
    kind = F.col("source_row") % 5
    broken = F.when(kind == 0, F.concat(F.lit('first\n"second", '), F.col("employee_id"), F.lit("\n\nlast"))).when(
        kind == 1, F.concat(F.lit('said ""\r\n'), F.col("order_status"))).when(kind == 2, '"').otherwise(F.col("order_notes"))
    orders = orders.withColumn("order_notes", broken)
    folder, _ = written_as_csv(orders.withColumn("at", F.col("source_row")).drop("source_row"), "orders", "at")
    read = bundle.read_bundle(ops.spark, folder, multiline=True)["orders"]
    return read


TOKENS = ("NA", "null", "None", "NONE", "nan", "N/A", "x")


@query("a02_null_tokens", """
SELECT CASE WHEN l_linenumber = 4 THEN 'NONE' WHEN l_linenumber = 7 THEN 'x' END AS token, COUNT(*) AS n_rows
FROM lineitem GROUP BY 1""")
def null_tokens(ops):
    """Texts that mean a missing value become null on reading; ``NONE`` stays."""
    token = F.element_at(F.array(*[F.lit(t) for t in TOKENS]), F.col("l_linenumber").cast("int"))
    df = ops.source("lineitem").select(F.col("l_orderkey").alias("k"), "l_orderkey", token.alias("token"))
    _, path = written_as_csv(df, "tokens", "k")
    read = bundle.read_csv_text(ops.spark, path)
    return read.groupBy(bundle.null_tokens_as_null("token")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("a04_source_position", "SELECT event_id, event_id + 2 AS source_row FROM events")
def source_position(ops):
    """Line numbers of rows read from many files."""
    df = ops.source("events").select(F.col("event_id").alias("k"), "event_id", "event_type")
    _, path = written_as_csv(df, "events", "k")
    return bundle.with_row_position(bundle.read_csv_text(ops.spark, path)).select(
        F.col("event_id").cast("bigint").alias("event_id"), "source_row")


SINK_TABLES = tuple(CONTRACT)


@query("a05_clean_and_rejected_sinks", with_ctes(" UNION ALL ".join(
    f"""SELECT '{n}' AS "table", COUNT(*) FILTER (WHERE reject_reason = '') AS clean_rows,
        COUNT(*) FILTER (WHERE reject_reason <> '') AS rejected_rows FROM judged_{n}""" for n in SINK_TABLES)))
def clean_and_rejected_sinks(ops):
    """Both layers written and read back."""
    done = clean.clean(RawTables(ops).only(*SINK_TABLES))
    folder = shared_path(ops.spark, "layers")
    sinks.write_layer(done.clean, f"{folder}/clean")
    sinks.write_layer(done.rejected, f"{folder}/rejected")
    parts = []
    for name in SINK_TABLES:
        kept = ops.spark.read.parquet(f"{folder}/clean/{name}").agg(F.count(F.lit(1)).alias("clean_rows"))
        lost = ops.spark.read.parquet(f"{folder}/rejected/{name}").agg(F.count(F.lit(1))).scalar()
        parts.append(kept.select(F.lit(name).alias("table"), "clean_rows", lost.alias("rejected_rows")))
    return reduce(DataFrame.union, parts)


@query("a06_report_sink", with_ctes(" UNION ALL ".join(
    f'SELECT "table", code, severity, "column", count, message FROM findings_{n}' for n in SINK_TABLES)))
def report_sink(ops):
    """Findings written as JSON and read back."""
    path = shared_path(ops.spark, "findings")
    sinks.write_report(validate.findings(RawTables(ops).numbered(*SINK_TABLES)), path)
    return ops.spark.read.schema(validate.FINDING).json(path).drop("sample_rows")


@query("a07_typed_load", with_ctes(cleaning._clean_sql("orders")))
def typed_load(ops):
    """The clean layer as CSV, loaded into declared types."""
    rows = clean.clean_rows(CONTRACT["orders"], cleaning.judged(ops, "orders"))
    path = shared_path(ops.spark, "clean-orders")
    bundle.write_csv(rows, path)
    return bundle.typed(bundle.read_csv_text(ops.spark, path), CONTRACT["orders"])


def _total(kind: str, column: str) -> str:
    """A number that any lost, added or changed value of a typed column moves; in words both engines know."""
    return {"string": f"SUM(length({column}))", "integer": f"SUM({column})", "number": f"SUM(CAST({column} AS DECIMAL(12,2)))",
            "boolean": f"SUM(CASE WHEN {column} THEN 1 ELSE 0 END)",
            "date": f"SUM({column} - DATE '2000-01-01')"}[kind]


TYPED = {name: [(f.name, f.kind) for f in table.fields] for name, table in CONTRACT.items()}


@query("a07_typed_load_all", with_ctes(rounded(" UNION ALL ".join(
    f"""SELECT '{name}' AS "table", '{c}' AS "column", COUNT(v_{c}) AS n_values,
        CAST({_total(kind, 'v_' + c)} AS DOUBLE) AS total FROM judged_{name} WHERE reject_reason = ''"""
    for name, columns in TYPED.items() for c, kind in columns), ("total",))))
def typed_load_all(ops):
    """The clean layer of all tables as CSV, loaded into declared types; values and totals of every column."""
    # Clean rows are written once, so only parents are written before.
    done = clean.clean(RawTables(ops).only(*SINK_TABLES), keep=clean.RETAINED, leaves=False)
    folder = shared_path(ops.spark, "clean-csv")
    sinks.write_layer(done.clean, folder, csv=True, fast=True)
    parts = []
    for name, columns in TYPED.items():
        rows = bundle.typed(bundle.read_csv_text(ops.spark, f"{folder}/{name}"), CONTRACT[name])
        sums = [F.expr(_total(kind, c) if kind != "date" else f"SUM(datediff({c}, DATE'2000-01-01'))").cast("double")
                for c, kind in columns]
        entries = rows.agg(F.array(*[
            F.struct(F.lit(name).alias("table"), F.lit(c).alias("column"), F.count(c).alias("n_values"), total.alias("total"))
            for (c, _), total in zip(columns, sums)]).alias("entries"))
        parts.append(entries.select(F.inline("entries")))
    return reduce(DataFrame.union, parts)


@query("a08_publish_reconciled", with_ctes(" UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", COUNT(*) AS n_rows FROM judged_{n} WHERE reject_reason = ''" for n in SINK_TABLES)))
def publish_reconciled(ops):
    """All clean tables published together after their counts agreed with the cleaning summary, then read back."""
    done = clean.clean(RawTables(ops).only(*SINK_TABLES), keep=clean.RETAINED)
    after = {r["table"]: r["rows_after"] for r in done.summary.collect()}  # one row per table
    target = shared_path(ops.spark, "published")
    sinks.publish(done.clean, target, {name: after[name] for name in done.clean})
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
             for name, df in sinks.read_published(ops.spark, target).items()]
    return reduce(DataFrame.union, parts)


@query("a09_replaced_derived", with_ctes(rounded(
    "SELECT order_id, processing_days, is_late, warehouse_load FROM features", ("processing_days",))))
def replaced_derived(ops):
    """A derived table replaced twice and read back."""
    path = shared_path(ops.spark, "order_features")
    rows = features.order_features(ops).select("order_id", "processing_days", "is_late", "warehouse_load")
    for _ in range(2):
        sinks.replace_derived(rows, path)
    return sinks.read_derived(ops.spark, path)


@query("a10_table_scan", with_ctes("SELECT * FROM ops_suppliers"))
def table_scan(ops):
    """A whole published table."""
    target = shared_path(ops.spark, "published")
    sinks.publish({"suppliers": ops["suppliers"]}, target, {"suppliers": ops["suppliers"].count()})
    return sinks.read_published(ops.spark, target)["suppliers"]


@query("a10_catalog_scan", with_ctes("""
SELECT snapshot_id, product_id, warehouse_id, snapshot_date FROM ops_inventory_snapshots
WHERE quantity_on_hand = 0 AND date_trunc('month', snapshot_date) = (
    SELECT date_trunc('month', MAX(snapshot_date)) FROM ops_inventory_snapshots)"""))
def catalog_scan(ops):
    """Empty shelves of the latest month, out of a published table in the session's catalog that is split by month."""
    target = shared_path(ops.spark, "published")
    month = F.date_format("snapshot_date", "yyyy-MM").alias("month")
    # The rows of a month meet before they are written, in several tasks where there are many.
    dealt = ops["inventory_snapshots"].select("*", month).hint("rebalance", F.col("month"))
    sinks.publish({"inventory_snapshots": dealt}, target, None, partitions={"inventory_snapshots": ["month"]})
    (name,) = sinks.register_published(ops.spark, target)
    latest = ops.spark.table(name).agg(F.max("month")).first()[0]
    return sinks.scan(ops.spark, name, ["snapshot_id", "product_id", "warehouse_id", "snapshot_date"],
                      (F.col("month") == latest) & (F.col("quantity_on_hand") == 0))


def with_derived(ops) -> dict[str, DataFrame]:
    """The tables, with what several relations derive from the facts by shuffles written: what suppliers ship of an order, which
    gives marks and deliveries, snapshots and order totals."""
    shipped = staged(ops.shipped(), "shipped")
    return {
        **ops,
        "supplier_marks": shipped.select("order_id", "supplier_id", "supplier_late"),
        "deliveries": staged(ops.deliveries_of(shipped), "deliveries"),
        "inventory_snapshots": staged(ops["inventory_snapshots"], "inventory_snapshots"),
        "order_totals": staged(kpi.order_totals(ops), "order-totals"),
    }


def star_relations(ops) -> dict[str, DataFrame]:
    """The fifteen relations of the reporting star; the facts are derived once for all of them."""
    ops = with_derived(ops)
    feats = staged(features.order_features(ops, stored=True), "features")
    return {
        **{name: plan(ops) for name, plan in VIEWS.items()},
        "customer_segments": segments.customer_segments(ops),
        "anomalies": features.anomalies(feats),
        "order_features": feats,
        "stat_tests": features.statistical_tests(feats, ops["supplier_marks"], analytics.WAREHOUSE),
        "dim_date": calendar_of(ops["order_headers"], "order_date"),
        "warehouses": ops["warehouses"],
        "suppliers": ops["suppliers"],
        "products": ops["products"],
        "inventory_snapshots": ops["inventory_snapshots"],
    }


STAR_SQL = {
    "vw_orders_enriched": "kpi_orders_enriched", "vw_monthly_kpis": "kpi_monthly",
    "vw_warehouse_performance": "kpi_warehouse", "vw_supplier_performance": "kpi_supplier",
    "vw_inventory_status": "kpi_inventory_status", "vw_customer_rfm": "kpi_rfm", "customer_segments": "ops_customers",
    "order_features": "features", "warehouses": "ops_warehouses", "suppliers": "ops_suppliers",
    "products": "ops_products", "inventory_snapshots": "ops_inventory_snapshots", "anomalies": "all_anomalies",
}


@query("a11_star_export", with_ctes(" UNION ALL ".join(
    [f"SELECT '{n}' AS relation, COUNT(*) AS n_rows FROM {s}" for n, s in STAR_SQL.items()] + [
        "SELECT 'stat_tests', 2", "SELECT 'root_cause', COUNT(*) FROM factors WHERE dimension_rank <= 3",
        "SELECT 'dim_date', date_diff('day', MIN(order_date), MAX(order_date)) + 1 FROM ops_orders"])))
def star_export(ops):
    """Rows read back from the exported star, all of its relations."""
    folder = shared_path(ops.spark, "star")
    a, b = decomposition.periods(ops)
    top = decompose.top_factors(decompose.decompose_months(ops, a, b))
    overall = decompose.overall_rates(
        ops["order_headers"].withColumn("fulfilled", kpi.is_fulfilled()),
        in_month("order_date", a), in_month("order_date", b))
    report = decompose.flat_report(top, overall, a, b)
    names = sinks.export_star(star_relations(ops), report, folder)
    parts = [
        bundle.read_csv_text(ops.spark, f"{folder}/{name}", multiline=False).agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("relation"), "n_rows")
        for name in names
    ]
    return reduce(DataFrame.union, parts)


def bucketed(ops) -> BucketedFacts:
    """The operational tables with their facts by bucket of the order."""
    buckets = int(ops.spark.conf.get("spark.sql.shuffle.partitions"))
    return BucketedFacts(ops, shared_path(ops.spark, "facts"), buckets)


@query("e02_bucketed_fact_to_fact", with_ctes("""
SELECT o.order_id, o.order_status, i.product_id, i.quantity FROM ops_orders AS o
JOIN ops_order_items AS i ON i.order_id = o.order_id"""))
def bucketed_fact_to_fact(ops):
    """Orders and items joined bucket by bucket."""
    facts = bucketed(ops)
    return fact_join(facts["order_headers"], facts["order_lines"], "order_id").select(
        "order_id", "order_status", "product_id", "quantity")


query("j07_bucketed_turnover", ORACLES["j07_inventory_turnover"])(lambda ops: kpi.inventory_turnover(bucketed(ops)))
query("j11_bucketed_orders_enriched", ORACLES["j11_orders_enriched"])(lambda ops: kpi.orders_enriched(bucketed(ops)))
query("l01_bucketed_order_facts", ORACLES["l01_order_facts"])(lambda ops: decompose.order_facts(bucketed(ops)))


_ENTRY = """CAST(user_id AS VARCHAR) AS run_id, event_type AS step,
       CASE WHEN value >= 100 THEN 'failed' WHEN value >= 30 THEN 'completed' ELSE 'running' END AS status, ts"""


@query("a13_appended_log", f"""
SELECT run_id, step, status, COUNT(*) AS entries FROM (SELECT {_ENTRY} FROM events) AS e GROUP BY 1, 2, 3""")
def appended_log(ops):
    """All events written as log entries in three appends, then counted."""
    return sinks.read_audit(ops.spark, log_of_events(ops)).groupBy("run_id", "step", "status").agg(
        F.count(F.lit(1)).alias("entries"))


@query("a14_latest_state", f"""
SELECT run_id, step, arg_max(status, (ts, status)) AS status, COUNT(*) AS entries
FROM (SELECT {_ENTRY} FROM events) AS e GROUP BY 1, 2""")
def latest_state(ops):
    """The last entry of every run and step, kept up to date by the appends."""
    return sinks.audit_state(ops.spark, log_of_events(ops)).select("run_id", "step", "status", "entries")


def log_of_events(ops) -> str:
    """A log with one entry per event, appended by thirds of the month."""
    status = F.when(F.col("value") >= 100, "failed").when(F.col("value") >= 30, "completed").otherwise("running")
    entries = ops.source("events").select(
        F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("step"), status.alias("status"),
        F.col("ts").cast("timestamp").alias("started_at"), F.col("ts").cast("timestamp").alias("ended_at"),
        F.col("event_id").alias("rows_processed"), F.lit("").alias("message"))
    path = shared_path(ops.spark, "log")
    third = F.coalesce(F.least(F.floor((F.dayofmonth("started_at") - 1) / 10), F.lit(2)), F.lit(0))
    for i in range(3):
        sinks.append_audit(entries.filter(third == i), path)
    return path


@query("a15_registered_views", with_ctes(rounded("""
SELECT m.month, m.order_count, m.fulfilment_rate, COUNT(*) AS warehouses
FROM kpi_monthly AS m JOIN kpi_warehouse AS w ON w.month = m.month GROUP BY 1, 2, 3""", ("fulfilment_rate",))))
def registered_views(ops):
    """Two of the registered views joined in SQL."""
    chosen = {n: VIEWS[n] for n in ("vw_monthly_kpis", "vw_warehouse_performance")}
    for _ in range(2):
        sinks.register_views(chosen, ops)
    return ops.spark.sql("""
        SELECT m.month, m.order_count, m.fulfilment_rate, COUNT(*) AS warehouses
        FROM vw_monthly_kpis AS m JOIN vw_warehouse_performance AS w ON w.month = m.month
        GROUP BY m.month, m.order_count, m.fulfilment_rate""")

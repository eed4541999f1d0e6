"""Layers, published versions, exports, views and the audit log."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from harborline.sources.bundle import write_csv
from harborline.sources.commits import Conflict, commit, last_commit, read_commit

# The relations of the reporting star.
STAR = (
    "vw_orders_enriched", "vw_monthly_kpis", "vw_warehouse_performance", "vw_supplier_performance",
    "vw_inventory_status", "vw_customer_rfm", "customer_segments", "anomalies", "order_features",
    "stat_tests", "dim_date", "warehouses", "suppliers", "products", "inventory_snapshots",
)


def write_layer(tables: Mapping[str, DataFrame], folder: str, csv: bool = False,
                partitions: Mapping[str, Sequence[str]] | None = None, fast: bool = False) -> dict[str, int]:
    """Write every table below a folder, empty ones with their columns; rows per table.

    Rows are counted while they are written. CSV is compressed by file, of which every task writes its own, and
    Parquet with zstd. ``partitions`` names the columns that a table's folders are split by; ``fast`` is that of ``write_csv``.
    """
    counts = {}
    for name, df in tables.items():
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        path = f"{folder.rstrip('/')}/{name}"
        if csv:
            write_csv(counted, path, "gzip", fast)
        else:
            counted.write.option("compression", "zstd").partitionBy(*(partitions or {}).get(name, ())).parquet(path)
        counts[name] = seen.get["rows"]
    return counts


def write_report(found: DataFrame, path: str) -> None:
    """Write findings as JSON lines."""
    found.write.json(path)


def replace_derived(df: DataFrame, path: str) -> int:
    """Replace a derived table once the rows written have been read back; the number of rows.

    The new table lies beside the old one until it is verified. Then a commit points to it, so readers have the old
    table or the new one, and after an error still the old one.
    """
    return publish({"derived": df}, path, None)["derived"]


def read_derived(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A derived table, as of its last replacement or an earlier one."""
    return read_published(spark, path, version)["derived"]


def publish(tables: Mapping[str, DataFrame], target: str, expected: Mapping[str, int] | None,
            based_on: int | None = None, partitions: Mapping[str, Sequence[str]] | None = None) -> dict[str, int]:
    """Publish all tables as the next version, or none of them; rows per table.

    The tables are written to a folder of their own. What can be read back must be what was written and, with
    ``expected``, what another account (such as the cleaning summary) says. Only then a commit names
    the folder; a mismatch raises and leaves the published version as it was. A version is based on the last
    one (or ``based_on``, which a caller has read); if another publisher commits meanwhile, ``Conflict`` is raised.
    """
    if expected is not None and set(expected) != set(tables):
        raise ValueError("expected counts must name exactly the published tables")
    spark = next(iter(tables.values())).sparkSession
    before = last_commit(spark, target) if based_on is None else based_on
    folder = f"versions/{uuid.uuid4().hex}"
    written = write_layer(tables, f"{target.rstrip('/')}/{folder}", partitions=partitions)
    counts = {name: spark.read.schema(df.schema).parquet(f"{target.rstrip('/')}/{folder}/{name}").count()
              for name, df in tables.items()}
    lost = {name: n for name, n in counts.items() if n != written[name]}
    if lost:
        raise RuntimeError("rows read back differ from those written: " + ", ".join(
            f"{name} has {n} instead of {written[name]}" for name, n in sorted(lost.items())))
    wrong = {name: (n, expected[name]) for name, n in counts.items() if n != expected[name]} if expected is not None else {}
    if wrong:
        raise RuntimeError("published rows differ from the cleaning summary: " + ", ".join(
            f"{name} has {n} instead of {e}" for name, (n, e) in sorted(wrong.items())))
    commit(spark, target, before + 1, {
        "folder": folder, "published_at": datetime.now(timezone.utc).isoformat(), "rows": counts,
        "tables": {name: df.schema.json() for name, df in tables.items()},
        "partitions": {name: list(c) for name, c in (partitions or {}).items()},
    })
    return counts


def read_published(spark: SparkSession, target: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a published version, the last one by default.

    A reader that keeps the number of a version reads the same rows however often others publish.
    """
    entry = read_commit(spark, target, last_commit(spark, target) if version is None else version)
    return {name: spark.read.schema(_schema(text)).parquet(f"{target.rstrip('/')}/{entry['folder']}/{name}")
            for name, text in entry["tables"].items()}


def _schema(text: str) -> StructType:
    return StructType.fromJson(json.loads(text))


def register_published(spark: SparkSession, target: str, version: int | None = None, prefix: str = "published_") -> list[str]:
    """Enter the tables of a version in the session's catalog, replacing earlier entries; their names.

    The catalog knows the partitions of a partitioned table, so a filter on them is answered without listing the others.
    """
    entry = read_commit(spark, target, last_commit(spark, target) if version is None else version)
    names = []
    for name, text in entry["tables"].items():
        known = f"{prefix}{name}"
        spark.sql(f"DROP TABLE IF EXISTS {known}")
        split = entry["partitions"].get(name, [])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _schema(text).fields)
        by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in split)})" if split else ""
        path = f"{target.rstrip('/')}/{entry['folder']}/{name}".replace("'", "\'")
        spark.sql(f"CREATE TABLE {known} ({columns}) USING parquet {by} LOCATION '{path}'")
        if split:
            spark.catalog.recoverPartitions(known)
        names.append(known)
    return names


def scan(spark: SparkSession, table: str, columns: Sequence[str] | None = None, where: Column | str | None = None) -> DataFrame:
    """Rows of a catalog table; the filter and the choice of columns reach the scan."""
    df = spark.table(table)
    df = df if where is None else df.filter(where)
    return df if columns is None else df.select(*columns)


def export_star(relations: Mapping[str, DataFrame], report: DataFrame, folder: str) -> dict[str, int]:
    """Write the reporting star and the flat report as CSV; rows per relation."""
    missing = [name for name in STAR if name not in relations]
    if missing:
        raise RuntimeError("relations missing for the export: " + ", ".join(missing))
    chosen = {name: relations[name] for name in STAR}
    return write_layer({**chosen, "root_cause": report}, folder, csv=True, fast=True)


def register_views(plans: Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame]],
                   ops: Mapping[str, DataFrame]) -> list[str]:
    """Register each plan as a temporary view, replacing an earlier one."""
    for name, plan in plans.items():
        plan(ops).createOrReplaceTempView(name)
    return list(plans)


def result_sample(df: DataFrame, rows: int) -> DataFrame:
    """The first rows of a result."""
    if rows < 0:
        raise ValueError("rows must not be negative")
    return df.limit(rows)


AUDIT = ("run_id string, step string, status string, started_at timestamp, ended_at timestamp, "
         "rows_processed bigint, message string")


def audit_rows(spark: SparkSession, run_id: str, outcomes: Sequence[tuple], steps: Sequence[str]) -> DataFrame:
    """Audit entries of a run: its outcomes, and ``skipped`` for the steps after a failure.

    An outcome is (step, status, started_at, ended_at, rows, message).
    """
    known = set(steps)
    if any(o[0] not in known for o in outcomes):
        raise ValueError("outcome of an unknown step")
    rows = [(run_id, *o) for o in outcomes]
    if any(o[1] == "failed" for o in outcomes):
        end = max(o[3] for o in outcomes)
        seen = {o[0] for o in outcomes}
        rows += [(run_id, s, "skipped", end, end, 0, "an earlier step failed") for s in steps if s not in seen]
    return spark.createDataFrame(rows, AUDIT)


ENTRY = ["status", "started_at", "ended_at", "rows_processed", "message"]
STATE = f"{AUDIT}, entries bigint, bucket int"
BUCKETS = 64
ATTEMPTS = 20


def _bucket() -> Column:
    return F.pmod(F.xxhash64("run_id", "step"), F.lit(BUCKETS)).cast("int").alias("bucket")


def _merged(rows: DataFrame) -> DataFrame:
    """The last entry and the number of entries of each run and step, out of rows that stand for ``entries`` of them."""
    last = F.max_by(F.struct(*ENTRY), F.struct("ended_at", "started_at", "status")).alias("last")
    return rows.groupBy("run_id", "step").agg(last, F.sum("entries").alias("entries")).select(
        "run_id", "step", "last.*", "entries", _bucket())


def _state(spark: SparkSession, path: str, folders: Mapping[str, str]) -> DataFrame:
    """State rows of the given buckets, a folder for each."""
    paths = sorted({f"{path.rstrip('/')}/{folder}/part={bucket}" for bucket, folder in folders.items()})
    return spark.read.schema(STATE).parquet(*paths) if paths else spark.createDataFrame([], STATE)


def append_audit(df: DataFrame, path: str) -> int:
    """Append entries to the audit log and bring the latest states up to date; the number of the commit.

    States lie in ``BUCKETS`` by run and step. Only buckets that the new entries touch are read, merged and written
    again; one commit names the new entries and the new buckets together. Appends commute, so
    one that loses to another writer merges with what that one left.
    """
    spark = df.sparkSession
    fresh = f"entries/{uuid.uuid4().hex}"
    df.select(*[c.split()[0] for c in AUDIT.split(", ")]).write.parquet(f"{path.rstrip('/')}/{fresh}")
    entries = spark.read.schema(AUDIT).parquet(f"{path.rstrip('/')}/{fresh}")
    touched = {str(r["bucket"]) for r in entries.select(_bucket()).distinct().collect()}  # at most BUCKETS
    for _ in range(ATTEMPTS):
        before = last_commit(spark, path)
        buckets = read_commit(spark, path, before)["buckets"] if before else {}
        old = _state(spark, path, {b: f for b, f in buckets.items() if b in touched})
        merged = _merged(old.drop("bucket").unionByName(entries.withColumn("entries", F.lit(1).cast("bigint"))))
        folder = f"state/{uuid.uuid4().hex}"
        merged.withColumn("part", F.col("bucket")).write.partitionBy("part").parquet(f"{path.rstrip('/')}/{folder}")
        try:
            commit(spark, path, before + 1, {"entries": fresh, "buckets": {**buckets, **dict.fromkeys(touched, folder)}})
            return before + 1
        except Conflict:
            continue
    raise Conflict(f"other writers kept appending to {path}")


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """All entries of the log that are committed."""
    last = last_commit(spark, path)
    folders = [f"{path.rstrip('/')}/{read_commit(spark, path, n)['entries']}" for n in range(1, last + 1)]
    return spark.read.schema(AUDIT).parquet(*folders) if folders else spark.createDataFrame([], AUDIT)


def audit_state(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Last entry of each run and step, and its number of entries, as kept by ``append_audit``."""
    last = last_commit(spark, path) if version is None else version
    return _state(spark, path, read_commit(spark, path, last)["buckets"] if last else {}).drop("bucket")


def latest_audit(log: DataFrame) -> DataFrame:
    """Last entry of each run and step, recomputed from all entries of a log."""
    return _merged(log.withColumn("entries", F.lit(1).cast("bigint"))).drop("entries", "bucket")

"""Rule evaluation over raw tables.

A rule yields violations, rows of (table, code, column, data_row). All rules that
look at one row only are evaluated in the same pass over the table. Keys are
checked through their distinct values. Findings aggregate the violations and keep
the first ten row numbers of each.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce
from types import MappingProxyType

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.contract import CONTRACT, FIX, REJECT, SEVERITIES, WARN, Table, known
from harborline.operators import keysets
from harborline.operators.joins import repeated_keys
from harborline.operators.parsing import ISO, found_sql, number_sql, once_sql, parsed_sql, strip_sql, title_sql
from harborline.operators.storage import staged

SAMPLE_ROWS = 10

SEVERITY = {
    "missing_file": REJECT,
    "missing_column": REJECT,
    "null_required": REJECT,
    "null_optional": WARN,
    "invalid_type": REJECT,
    "duplicate_primary_key": REJECT,
    "foreign_key_not_found": REJECT,
    "negative_value": FIX,
    "inconsistent_category_casing": FIX,
    "delivered_before_shipped": FIX,
}

MESSAGE = {
    "null_required": "required values are null in {column}",
    "null_optional": "optional values are null in {column}",
    "invalid_type": "{column} has values of another type",
    "duplicate_primary_key": "{column} repeats a primary key",
    "foreign_key_not_found": "{column} refers to rows that do not exist",
    "negative_value": "{column} has negative values",
    "inconsistent_category_casing": "{column} is not in title case",
    "delivered_before_shipped": "{column} precedes the shipping date",
    "missing_column": "required columns are missing: {column}",
    "missing_file": "no file for table {column}",
}

def row_rules(table: Table, present: set[str]) -> list[tuple[str, str, str]]:
    """(code, column, condition) of every rule decided by one row alone, over a frame of ``_parsed``."""
    rules = []
    for spec in table.fields:
        name = spec.name
        if name not in present:
            continue
        if not spec.optional:
            rules.append(("null_required", name, f"{name} IS NULL"))
        elif spec.kind == "string":
            rules.append(("null_optional", name, f"{name} IS NULL"))
        if spec.kind != "string":
            rules.append(("invalid_type", name, f"{name} IS NOT NULL AND _v_{name} IS NULL"))
    for name in table.non_negative:
        if name in present:
            rules.append(("negative_value", name, f"({number_sql('_s_' + name)}) < 0"))
    if table.title_cased in present:
        name = table.title_cased
        rules.append(("inconsistent_category_casing", name, f"{name} <> {title_sql(name)}"))
    if table.ordered_dates and present.issuperset(table.ordered_dates):
        first, second = table.ordered_dates
        rules.append(("delivered_before_shipped", second, f"_v_{second} < _v_{first}"))
    return rules


def _parsed(table: Table, frame: DataFrame, formats: Mapping[str, str]) -> DataFrame:
    """``frame`` with the stripped texts (``_s_``) and the values (``_v_``) of its columns of other kinds than text.

    Two projections, so that every text is stripped and parsed once for all rules.
    """
    typed = [f for f in table.fields if f.kind != "string" and f.name in frame.columns]
    stripped = frame.selectExpr("*", *[f"{strip_sql(f.name)} AS _s_{f.name}" for f in typed])
    return stripped.selectExpr("*", *[
        f"{parsed_sql('_s_' + f.name, f.kind, formats.get(f.name, ISO))} AS _v_{f.name}" for f in typed])


def _labelled(df: DataFrame, table: str, code: str, column: str) -> DataFrame:
    return df.select(
        F.lit(table).alias("table"), F.lit(code).alias("code"), F.lit(column).alias("column"), "data_row"
    )


def table_violations(table: Table, frame: DataFrame, tables: Mapping[str, DataFrame],
                     codes: Collection[str], formats: Mapping[str, str] = MappingProxyType({})) -> list[DataFrame]:
    """Violations of one table, limited to ``codes``; ``frame`` has a 1-based ``data_row``."""
    present = set(frame.columns)
    marks = [
        (condition, f"named_struct('code', '{code}', 'column', '{column}')")
        for code, column, condition in row_rules(table, present) if code in codes
    ]
    parts = []
    if marks:
        found = once_sql(found_sql(marks, "STRUCT<code: STRING, column: STRING>"))
        parts.append(
            _parsed(table, frame, formats).selectExpr("data_row", f"{found} AS _found").selectExpr("data_row", "inline(_found)").selectExpr(
                f"'{table.name}' AS table", "code", "column", "data_row"
            )
        )
    if table.key in present and "duplicate_primary_key" in codes:
        # Repeated keys are found on hashes, and only their rows are compared by the key.
        keyed = staged(keysets.repeated(frame.select(table.key, "data_row"), table.key), "repeated-keys")
        repeated = keyed.join(repeated_keys(keyed, [table.key]), table.key, "left_semi")
        parts.append(_labelled(repeated, table.name, "duplicate_primary_key", table.key))
    referring = [
        (column, parent) for column, parent in table.parents.items()
        if "foreign_key_not_found" in codes and column in present and parent in tables
        and CONTRACT[parent].key in tables[parent].columns
    ]
    if referring:
        # Parents are bitmaps, so all keys of a row are compared where it lies.
        marked = frame.select("data_row", *[column for column, _ in referring])
        for column, parent in referring:
            marked = keysets.with_membership(marked, column, tables[parent], CONTRACT[parent].key, f"_in_{column}")
        lost = found_sql([(f"{column} IS NOT NULL AND NOT _in_{column}", f"'{column}'") for column, _ in referring], "STRING")
        parts.append(marked.selectExpr("data_row", f"{once_sql(lost)} AS _lost").selectExpr("data_row", "explode(_lost) AS column").selectExpr(
            f"'{table.name}' AS table", "'foreign_key_not_found' AS code", "column", "data_row"))
    return parts


def missing_columns(spark, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One finding per table that lacks contract columns; reads metadata only."""
    rows = []
    for name, frame in tables.items():
        lacking = [c for c in CONTRACT[name].columns if c not in frame.columns]
        if lacking:
            rows.append((name, "missing_column", REJECT, None, len(lacking),
                         MESSAGE["missing_column"].format(column=", ".join(lacking)), []))
    return spark.createDataFrame(rows, FINDING)


def lacking_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table`` and ``affected_rows``, the rows of every table that lacks contract columns; no column is read."""
    counted = [
        frame.agg(F.count(F.lit(1)).alias("affected_rows")).select(F.lit(name).alias("table"), "affected_rows")
        for name, frame in tables.items() if not set(CONTRACT[name].columns).issubset(frame.columns)
    ]
    none = next(iter(tables.values())).sparkSession.createDataFrame([], "table string, affected_rows bigint")
    return reduce(DataFrame.union, counted, none)


FINDING = ("table string, code string, severity string, column string, count bigint, message string, "
           "sample_rows array<bigint>")


def aggregate_violations(violations: DataFrame) -> DataFrame:
    """Findings out of violations, narrow rows that are written once because they are read twice.

    Counts are partial sums per rule. Row numbers are ranked inside their rule and cut to the
    first ones; Spark applies that limit in each task before the shuffle too, so a task sends
    at most ten rows per rule however many break it.
    """
    violations = staged(violations, "violations")
    rule = ["table", "code", "column"]
    totals = violations.groupBy(*rule).agg(F.count(F.lit(1)).alias("count"))
    rank = F.row_number().over(Window.partitionBy(*rule).orderBy("data_row"))
    samples = violations.select(*rule, "data_row", rank.alias("rank")).filter(F.col("rank") <= SAMPLE_ROWS)
    samples = samples.groupBy(*rule).agg(F.sort_array(F.collect_list("data_row")).alias("sample_rows"))
    severity = " ".join(f"WHEN '{code}' THEN '{level}'" for code, level in SEVERITY.items())
    message = " ".join(f"WHEN '{code}' THEN '{text}'" for code, text in MESSAGE.items())
    return totals.join(samples, rule).selectExpr(
        "table", "code", f"CASE code {severity} END AS severity", "column", "count",
        f"replace(CASE code {message} END, '{{column}}', column) AS message", "sample_rows",
    )


def violations(tables: Mapping[str, DataFrame], codes: Collection[str] = tuple(SEVERITY),
               formats: Mapping[str, Mapping[str, str]] = MappingProxyType({})) -> DataFrame:
    """Violations of all supplied tables, in contract order."""
    known(tables)
    parts = [
        part for name, table in CONTRACT.items() if name in tables
        for part in table_violations(table, tables[name], tables, codes, formats.get(name, {}))
    ]
    return reduce(DataFrame.union, parts)


def findings(tables: Mapping[str, DataFrame], codes: Collection[str] = tuple(SEVERITY),
             formats: Mapping[str, Mapping[str, str]] = MappingProxyType({})) -> DataFrame:
    """Findings of the supplied tables, limited to ``codes``.

    A foreign key is checked only if its parent table is supplied as well. Dates are ISO but for
    columns that ``formats`` names by table (see ``date_formats``).
    """
    broken = aggregate_violations(violations(tables, codes, formats))
    if "missing_column" not in codes:
        return broken
    return missing_columns(broken.sparkSession, tables).unionByName(broken)


def summarise(found: DataFrame) -> DataFrame:
    """Affected rows per table and severity, and the grand total (null table)."""
    counts = [F.sum(F.when(F.col("severity") == s, F.col("count")).otherwise(0)).alias(s) for s in SEVERITIES]
    return found.rollup("table").agg(
        *counts, F.sum("count").alias("issue_count"), F.count(F.lit(1)).alias("findings"),
        F.grouping("table").cast("boolean").alias("is_total"),
    )


def published_rules(table: Table, present: set[str]) -> list[tuple[str, str, str]]:
    """(rule, column, violation) of the published, typed layer.

    Empty optional text has been replaced by its default, so only optional values of
    other kinds may be null.
    """
    rules = [("not_null", f.name, f"{f.name} IS NULL") for f in table.fields
             if f.name in present and not (f.optional and f.kind != "string")]
    rules += [("non_negative", c, f"{c} < 0") for c in table.non_negative if c in present]
    rules += [("positive", c, f"{c} <= 0") for c in table.positive if c in present]
    rules += [("not_before_1900", c, f"{c} < DATE'1900-01-01'") for c in table.not_before_1900 if c in present]
    if table.ordered_dates and present.issuperset(table.ordered_dates):
        first, second = table.ordered_dates
        rules.append(("date_order", second, f"{second} < {first}"))
    return rules


def _total(df: DataFrame, table: str, rule: str, column: str) -> DataFrame:
    return df.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations")).select(
        F.lit(table).alias("table"), F.lit(rule).alias("rule"), F.lit(column).alias("column"), "violations"
    )


def contract_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Number of rows that break each published-layer constraint, zero counts included."""
    known(tables)
    parts = []
    for name, frame in tables.items():
        table = CONTRACT[name]
        present = set(frame.columns)
        rules = published_rules(table, present)
        counted = frame.selectExpr(*[f"count_if({c}) AS r{i}" for i, (_, _, c) in enumerate(rules)])
        entries = ", ".join(
            f"named_struct('table', '{name}', 'rule', '{rule}', 'column', '{column}', 'violations', r{i})"
            for i, (rule, column, _) in enumerate(rules)
        )
        parts.append(counted.selectExpr(f"inline(array({entries}))"))

        parts.append(_total(repeated_keys(frame, [table.key]), name, "primary_key", table.key))
        for column, parent in table.parents.items():
            if parent in tables and column in present:
                referred = tables[parent].select(F.col(CONTRACT[parent].key).alias(column)).distinct()
                # Child keys are reduced to one row each before the join.
                orphans = frame.filter(F.col(column).isNotNull()).groupBy(column).agg(
                    F.count(F.lit(1)).alias("rows")).join(referred, column, "left_anti")
                parts.append(_total(orphans, name, "foreign_key", column))
    return reduce(DataFrame.union, parts)


def assert_contract(tables: Mapping[str, DataFrame]) -> None:
    """Raise if the published layer breaks any constraint."""
    broken = contract_violations(tables).filter("violations > 0").collect()  # at most one row per rule
    if broken:
        text = ", ".join(f"{r['table']}.{r['column']} {r['rule']}: {r['violations']}" for r in broken)
        raise ValueError("published layer breaks its constraints: " + text)

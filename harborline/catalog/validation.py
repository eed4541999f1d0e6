"""Contract findings over the raw tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.catalog import raw_ctes  # noqa: F401  (defines the SQL tables)
from harborline.catalog.ctes import with_ctes
from harborline.catalog.registry import query
from harborline.contract import CONTRACT
from harborline.operators import keysets, validate
from harborline.sources.raw import RawTables

ALL_FINDINGS = " UNION ALL ".join(f"SELECT * FROM findings_{name}" for name in CONTRACT)


# Rules that only some tables have.
ONLY = {
    "negative_value": ("warehouses", "products", "order_items", "inventory_snapshots"),
    "inconsistent_category_casing": ("products",),
    "delivered_before_shipped": ("deliveries",),
}


def _findings(code):
    def plan(ops):
        found = validate.findings(RawTables(ops).numbered(*ONLY.get(code, ())), codes=[code])
        return found.withColumn("sample_rows", F.array_join("sample_rows", ","))

    return plan


for _key, _code in (
    ("b02_null_required", "null_required"),
    ("b03_null_optional", "null_optional"),
    ("b04_invalid_type", "invalid_type"),
    ("b05_duplicate_primary_key", "duplicate_primary_key"),
    ("b06_negative_value", "negative_value"),
    ("b07_category_casing", "inconsistent_category_casing"),
    ("b08_delivered_before_shipped", "delivered_before_shipped"),
    ("b09_foreign_key_not_found", "foreign_key_not_found"),
):
    query(_key, with_ctes(f"SELECT * FROM ({ALL_FINDINGS}) AS f WHERE code = '{_code}'"))(_findings(_code))


PARENTS = {name: dict(table.parents) for name, table in CONTRACT.items() if table.parents}


@query("b09_orphans_by_bitmap", with_ctes(" UNION ALL ".join(
    f"""SELECT '{name}' AS "table", '{column}' AS "column", source_row FROM raw_{name} WHERE {column} IS NOT NULL AND {column} NOT IN (
        SELECT {CONTRACT[parent].key} FROM raw_{parent} WHERE {CONTRACT[parent].key} IS NOT NULL)"""
    for name, parents in PARENTS.items() for column, parent in parents.items())))
def orphans_by_bitmap(ops):
    """Every row of a table with a foreign key that its parent lacks; parent keys travel as bitmaps."""
    raw = RawTables(ops)
    parts = [
        keysets.orphans(raw[name].select("source_row", column), column, raw[parent], CONTRACT[parent].key).select(
            F.lit(name).alias("table"), F.lit(column).alias("column"), "source_row")
        for name, parents in PARENTS.items() for column, parent in parents.items()
    ]
    return reduce(DataFrame.union, parts)


@query("b10_sample_rows", with_ctes(
    f"""SELECT "table", code, "column", CAST(unnest(string_split(sample_rows, ',')) AS BIGINT) AS data_row
        FROM ({ALL_FINDINGS}) AS f"""))
def sample_rows(ops):
    """The first ten offending rows of every finding."""
    return validate.findings(RawTables(ops).numbered()).select(
        "table", "code", "column", F.explode("sample_rows").alias("data_row")
    )


@query("b11_severity_summary", with_ctes(f"""
SELECT "table", CAST(SUM(CASE WHEN severity = 'reject' THEN count ELSE 0 END) AS BIGINT) AS reject,
       CAST(SUM(CASE WHEN severity = 'fix' THEN count ELSE 0 END) AS BIGINT) AS fix,
       CAST(SUM(CASE WHEN severity = 'warn' THEN count ELSE 0 END) AS BIGINT) AS warn,
       CAST(SUM(count) AS BIGINT) AS issue_count, COUNT(*) AS findings, GROUPING("table") = 1 AS is_total
FROM ({ALL_FINDINGS}) AS f GROUP BY ROLLUP ("table")"""))
def severity_summary(ops):
    """Affected rows per table and severity, with the grand total."""
    return validate.summarise(validate.findings(RawTables(ops).numbered()))


raw_ctes.define("published_order_items", """
SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS order_item_id,
       l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price FROM lineitem""")

# Contract columns that the operational tables have.
PUBLISHED = {
    "suppliers": ("ops_suppliers", "supplier_id supplier_name"),
    "warehouses": ("ops_warehouses", "warehouse_id warehouse_name region"),
    "customers": ("ops_customers", "customer_id customer_name signup_date customer_segment"),
    "products": ("ops_products", "product_id product_name sku_group category unit_price"),
    "orders": ("ops_orders", "order_id customer_id warehouse_id employee_id order_date order_status"),
    "order_items": ("published_order_items", "order_item_id order_id product_id quantity unit_price"),
    "deliveries": ("ops_deliveries", "delivery_id order_id supplier_id warehouse_id shipped_date delivered_date "
                                     "promised_delivery_date supplier_late delivery_status"),
    "inventory_snapshots": ("ops_inventory_snapshots", "snapshot_id snapshot_date product_id warehouse_id "
                                                       "supplier_id quantity_on_hand reorder_point stockout_flag"),
    "support_tickets": ("ops_support_tickets", "ticket_id customer_id ticket_date issue_type priority "
                                               "resolution_status"),
}


def _published_sql() -> str:
    parts = []
    for name, (source, columns) in PUBLISHED.items():
        table, present = CONTRACT[name], columns.split()
        tests = [("not_null", f.name, f"{f.name} IS NULL") for f in table.fields
                 if f.name in present and f.name != "delivered_date"]
        tests += [("non_negative", c, f"{c} < 0") for c in table.non_negative if c in present]
        tests += [("positive", c, f"{c} <= 0") for c in table.positive]
        tests += [("not_before_1900", c, f"{c} < DATE '1900-01-01'") for c in table.not_before_1900 if c in present]
        if name == "deliveries":
            tests.append(("date_order", "delivered_date", "delivered_date < shipped_date"))
        tests.append(("primary_key", table.key, f"{table.key} IN (SELECT {table.key} FROM {source} "
                                                f"GROUP BY 1 HAVING COUNT(*) > 1)"))
        for column, parent in table.parents.items():
            if column in present and parent in PUBLISHED:
                tests.append(("foreign_key", column, f"{column} IS NOT NULL AND {column} NOT IN "
                                                     f"(SELECT {CONTRACT[parent].key} FROM {PUBLISHED[parent][0]})"))
        parts += [f"SELECT '{name}' AS \"table\", '{rule}' AS rule, '{column}' AS \"column\", "
                  f"COUNT(*) AS violations FROM {source} WHERE {condition}" for rule, column, condition in tests]
    return "\nUNION ALL\n".join(parts)


def published_tables(ops):
    """The operational tables under their contract names and columns."""
    tables = {name: ops[name].select(*columns.split()) for name, (_, columns) in PUBLISHED.items()
              if name != "order_items"}
    tables["order_items"] = ops.source("lineitem").selectExpr(
        "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS order_item_id",
        "l_orderkey AS order_id", "l_partkey AS product_id", "CAST(l_quantity AS BIGINT) AS quantity",
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price",
    )
    return tables


LACKING = {name: [c for c in CONTRACT[name].columns if c not in columns.split()] for name, (_, columns) in PUBLISHED.items()}


@query("b01_missing_columns", with_ctes(" UNION ALL ".join(
    f"""SELECT '{name}' AS "table", 'missing_column' AS code, 'reject' AS severity, CAST({len(columns)} AS BIGINT) AS count,
        'required columns are missing: {", ".join(columns)}' AS message, (SELECT COUNT(*) FROM {PUBLISHED[name][0]}) AS affected_rows"""
    for name, columns in LACKING.items() if columns)))
def missing_columns(ops):
    """Contract columns that the operational tables do not have, and the rows that lack them."""
    tables = published_tables(ops)
    found = validate.missing_columns(ops.spark, tables)
    return found.join(validate.lacking_rows(tables), "table").select(
        "table", "code", "severity", "count", "message", "affected_rows")


@query("b13_published_constraints", with_ctes(_published_sql()))
def published_constraints(ops):
    """Rows that break each constraint of the published layer."""
    return validate.contract_violations(published_tables(ops))

"""Cleaning and quarantine over the raw tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.catalog import raw_ctes  # noqa: F401  (defines the SQL tables)
from harborline.catalog.ctes import with_ctes
from harborline.catalog.registry import query, rounded
from harborline.contract import CASCADING_PARENT, CONTRACT
from harborline.functions import strip
from harborline.operators import clean, date_formats
from harborline.sources.raw import RawTables

# A table is judged together with the ancestors its keys refer to.
ANCESTRY = {
    "suppliers": ("suppliers",),
    "warehouses": ("warehouses",),
    "customers": ("customers",),
    "employees": ("employees",),
    "products": ("suppliers", "products"),
    "orders": ("customers", "warehouses", "employees", "orders"),
    "order_items": ("customers", "warehouses", "employees", "orders", "suppliers", "products", "order_items"),
    "deliveries": ("customers", "warehouses", "employees", "orders", "suppliers", "deliveries"),
    "inventory_snapshots": ("suppliers", "products", "warehouses", "inventory_snapshots"),
    "support_tickets": ("customers", "support_tickets"),
}


def judged(ops, name: str) -> DataFrame:
    return clean.judge(RawTables(ops).only(*ANCESTRY[name]))[name]


def _clean_sql(name: str) -> str:
    table = CONTRACT[name]
    columns = ", ".join(f"v_{f.name} AS {f.name}" for f in table.fields)
    doubles = [f.name for f in table.fields if f.kind == "number"]
    return rounded(f"SELECT {columns} FROM judged_{name} WHERE reject_reason = ''", doubles)


def _rejected_sql(name: str) -> str:
    columns = ", ".join(CONTRACT[name].columns)
    return f"SELECT source_row, {columns}, reject_reason FROM judged_{name} WHERE reject_reason <> ''"


def _clean_plan(name):
    return lambda ops: clean.clean_rows(CONTRACT[name], judged(ops, name))


def _rejected_plan(name):
    return lambda ops: clean.rejected_rows(judged(ops, name))


for _name in CONTRACT:
    query(f"c15_clean_{_name}", with_ctes(_clean_sql(_name)))(_clean_plan(_name))
    query(f"c15_rejected_{_name}", with_ctes(_rejected_sql(_name)))(_rejected_plan(_name))


def _reason_plan(chosen: dict[str, list[str]]):
    def plan(ops):
        # The tables and their ancestors are judged once and written, not again for every child.
        needed = {name for child in chosen for name in ANCESTRY[child]}
        everything = clean.judge(RawTables(ops).only(*needed), stage=True, keep=clean.VERDICTS)
        parts = [
            everything[name].select(F.lit(name).alias("table"), "source_row", F.explode("reasons").alias("reason"))
            .filter(F.col("reason").isin(*reasons))
            for name, reasons in chosen.items()
        ]
        return reduce(DataFrame.union, parts)

    return plan


def _reason_sql(chosen: dict[str, list[str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", source_row, reason "
        f"FROM (SELECT source_row, unnest(string_split(reject_reason, '; ')) AS reason "
        f"FROM judged_{name} WHERE reject_reason <> '') AS r WHERE reason IN ({', '.join(map(repr, reasons))})"
        for name, reasons in chosen.items()
    )


def _reasons(of) -> dict[str, list[str]]:
    """The reasons that ``of`` gives for each table, tables without any left out."""
    return {name: found for name, table in CONTRACT.items() if (found := of(table))}


def _kinds(*kinds: str):
    return lambda t: [f"invalid_type:{f.name}" for f in t.fields if f.kind in kinds]


for _key, _of in (
    ("c02_numeric_coercion", _kinds("integer", "number")),
    ("c03_boolean_coercion", _kinds("boolean")),
    ("c04_date_coercion", _kinds("date")),
    ("c07_required_null", lambda t: [f"null_required:{f.name}" for f in t.fields if not f.optional]),
    ("c09_negative_value", lambda t: [f"negative_value:{c}" for c in t.non_negative]),
    ("c10_delivered_before_shipped", lambda t: ["delivered_before_shipped"] if t.ordered_dates else []),
    ("c11_duplicate_after_first", lambda t: [f"duplicate_primary_key:{t.key}"]),
    ("c12_orphan_foreign_key", lambda t: [f"orphan_foreign_key:{c}" for c in t.parents]),
    ("c13_cascade", lambda t: ["cascade_parent_order_rejected"] if CASCADING_PARENT in t.parents.values() else []),
):
    query(_key, with_ctes(_reason_sql(_reasons(_of))))(_reason_plan(_reasons(_of)))


@query("c01_trimmed_text", with_ctes("""
SELECT source_row, changed, t_order_id AS order_id, t_order_notes AS order_notes, t_order_status AS order_status
FROM judged_orders WHERE order_notes IS DISTINCT FROM t_order_notes OR order_status IS DISTINCT FROM t_order_status"""))
def trimmed_text(ops):
    """Rows whose text changed by trimming, before defaults."""
    raw = RawTables(ops)["orders"]
    df = clean.normalise(CONTRACT["orders"], raw)
    value = F.col("value")
    cleared = F.when(F.col("raw.order_notes").isNull(), F.lit(None)).otherwise(value["order_notes"])
    return df.select(
        "source_row", "changed", value["order_id"].alias("order_id"), cleared.alias("order_notes"),
        value["order_status"].alias("order_status"), "raw",
    ).filter(
        ~F.col("raw.order_notes").eqNullSafe(F.col("order_notes"))
        | ~F.col("raw.order_status").eqNullSafe(F.col("order_status"))
    ).drop("raw")


# How some tables write their dates, and the columns it concerns.
LOCAL = {
    "customers": {"signup_date": ("$3/$2/$1", "day/month/year")},
    "employees": {"hire_date": ("$2-$3-$1", "month-day-year")},
    "orders": {"order_date": ("$2/$3/$1", "month/day/year")},
    "deliveries": {"shipped_date": ("$3.$2.$1", "day.month.year"), "delivered_date": ("$1/$2/$3", "year/month/day"),
                   "promised_delivery_date": ("$1$2$3", "yearmonthday")},
}


def local_tables(ops) -> dict[str, DataFrame]:
    """The raw tables of ``LOCAL`` with their dates written in formats of their own; texts that are no dates stay."""
    iso = r"^(\d{4})-(\d{2})-(\d{2})$"
    return {name: RawTables(ops)[name].withColumns({c: F.regexp_replace(c, iso, form) for c, (form, _) in columns.items()})
            for name, columns in LOCAL.items()}


def _iso_day_sql(column: str) -> str:
    return f"try_cast(CASE WHEN regexp_full_match({column}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN {column} END AS DATE)"


@query("b04_date_formats", with_ctes(" UNION ALL ".join(
    f"""SELECT '{name}' AS "table", '{c}' AS "column", CASE WHEN COUNT({_iso_day_sql(c)}) = 0 THEN 'iso' ELSE '{form}' END AS format,
        COUNT({c}) AS n_values, COUNT({_iso_day_sql(c)}) AS parsed,
        {"COUNT(*) FILTER (WHERE day(" + _iso_day_sql(c) + ") > 12) = 0 AND COUNT(*) FILTER (WHERE day(" + _iso_day_sql(c)
         + ") <> month(" + _iso_day_sql(c) + ")) > 0" if form[:3] in ("day", "mon") else "FALSE"} AS ambiguous FROM raw_{name}"""
    for name, columns in LOCAL.items() for c, (_, form) in columns.items())))
def found_date_formats(ops):
    """The format of every date column of tables that write their dates differently."""
    return date_formats.date_format_report(local_tables(ops))


@query("c04_local_dates", with_ctes(" UNION ALL ".join(
    f"""SELECT '{name}' AS "table", source_row, '{c}' AS "column", u_{c} AS day, t_{c} IS NOT NULL AND u_{c} IS NULL AS invalid
        FROM judged_{name}""" for name, columns in LOCAL.items() for c in columns)))
def local_dates(ops):
    """Days read from the formats that were found; the texts that are no dates are the same as in ISO tables."""
    tables = local_tables(ops)
    formats = date_formats.date_formats(tables)
    parts = []
    for name, columns in LOCAL.items():
        rows = clean.normalise(CONTRACT[name], tables[name], formats[name])
        # All date columns of a row in one pass over the table.
        entries = F.array(*[F.struct(
            F.lit(c).alias("column"), F.col(f"value.{c}").alias("day"),
            F.array_contains("reasons", f"invalid_type:{c}").alias("invalid")) for c in columns])
        parts.append(rows.select(F.lit(name).alias("table"), "source_row", F.inline(entries)))
    return reduce(DataFrame.union, parts)


TEXTS = {name: [f.name for f in t.fields] for name, t in CONTRACT.items()}


@query("c01_trimmed_columns", with_ctes(" UNION ALL ".join(
    f"""SELECT '{name}' AS "table", '{c}' AS "column", COUNT(*) FILTER (WHERE {c} IS DISTINCT FROM t_{c}) AS trimmed,
        COUNT(*) FILTER (WHERE {c} IS NOT NULL AND t_{c} IS NULL) AS emptied FROM judged_{name}"""
    for name, columns in TEXTS.items() for c in columns)))
def trimmed_columns(ops):
    """For every column of every table how many values trimming changed, and how many it left empty."""
    parts = []
    for name, columns in TEXTS.items():
        counts = []
        for c in columns:
            raw, text = F.col(c), strip(c)
            counts.append(F.struct(
                F.lit(name).alias("table"), F.lit(c).alias("column"),
                F.count_if(~raw.eqNullSafe(F.nullif(text, F.lit("")))).alias("trimmed"),
                F.count_if(raw.isNotNull() & (text == "")).alias("emptied")))
        parts.append(RawTables(ops)[name].agg(F.array(*counts).alias("counts")).select(F.inline("counts")))
    return reduce(DataFrame.union, parts)


@query("c05_title_cased_category", with_ctes("""
SELECT category AS raw_category, v_category AS category, COUNT(*) AS products,
       COUNT(*) FILTER (WHERE changed) AS changed
FROM judged_products GROUP BY 1, 2"""))
def title_cased_category(ops):
    """Raw and normalised category with the number of products."""
    df = clean.normalise(CONTRACT["products"], RawTables(ops)["products"])
    return df.groupBy(
        F.col("raw.category").alias("raw_category"), F.col("value.category").alias("category")
    ).agg(F.count(F.lit(1)).alias("products"), F.count_if("changed").alias("changed"))


DEFAULTED = {name: [f.name for f in t.fields if f.default is not None] for name, t in CONTRACT.items()}


@query("c06_defaults_filled", with_ctes(" UNION ALL ".join(
    f"""SELECT '{name}' AS "table", '{column}' AS "column", v_{column} AS value, COUNT(*) AS filled
        FROM judged_{name} WHERE u_{column} IS NULL GROUP BY 3"""
    for name, columns in DEFAULTED.items() for column in columns)))
def defaults_filled(ops):
    """How often each documented default replaced an empty optional text."""
    raw = RawTables(ops)
    parts = []
    for name, columns in DEFAULTED.items():
        df = clean.normalise(CONTRACT[name], raw[name])
        for column in columns:
            was_empty = F.col(f"raw.{column}").isNull() | (strip(f"raw.{column}") == "")
            parts.append(df.filter(was_empty).groupBy(F.col(f"value.{column}").alias("value")).agg(
                F.count(F.lit(1)).alias("filled")
            ).select(F.lit(name).alias("table"), F.lit(column).alias("column"), "value", "filled"))
    return reduce(DataFrame.union, parts)


@query("c08_distinct_reasons", with_ctes("""
SELECT source_row, len(string_split(reject_reason, '; ')) AS reasons,
       len(list_distinct(string_split(reject_reason, '; '))) AS distinct_reasons
FROM judged_order_items WHERE reject_reason <> ''"""))
def distinct_reasons(ops):
    """No reason is listed twice for a row."""
    return judged(ops, "order_items").filter(F.size("reasons") > 0).select(
        "source_row", F.size("reasons").alias("reasons"),
        F.size(F.array_distinct("reasons")).alias("distinct_reasons"),
    )


@query("c08_distinct_reasons_all", with_ctes(" UNION ALL ".join(
    f"""SELECT '{name}' AS "table", source_row, len(string_split(reject_reason, '; ')) AS reasons,
        len(list_distinct(string_split(reject_reason, '; '))) AS distinct_reasons
        FROM judged_{name} WHERE reject_reason <> ''""" for name in CONTRACT)))
def distinct_reasons_all(ops):
    """The same for the rows of all tables."""
    parts = [
        df.filter(F.size("reasons") > 0).select(
            F.lit(name).alias("table"), "source_row", F.size("reasons").alias("reasons"),
            F.size(F.array_distinct("reasons")).alias("distinct_reasons"))
        for name, df in clean.judge(RawTables(ops), stage=True, keep=clean.VERDICTS).items()
    ]
    return reduce(DataFrame.union, parts)


@query("c14_reason_lists", with_ctes(" UNION ALL ".join(
    f"""SELECT '{name}' AS "table", reject_reason, COUNT(*) AS rows_rejected
        FROM judged_{name} WHERE reject_reason <> '' GROUP BY 2""" for name in CONTRACT)))
def reason_lists(ops):
    """Ordered reason lists with the number of rows that carry them."""
    everything = clean.judge(RawTables(ops), stage=True, keep=clean.VERDICTS)
    parts = [
        clean.rejected_rows(df).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows_rejected"))
        .select(F.lit(name).alias("table"), "reject_reason", "rows_rejected")
        for name, df in everything.items()
    ]
    return reduce(DataFrame.union, parts)


@query("c16_cleaning_summary", with_ctes(
    "SELECT COALESCE(\"table\", 'TOTAL') AS \"table\", CAST(SUM(rows_before) AS BIGINT) AS rows_before, "
    "CAST(SUM(rows_after) AS BIGINT) AS rows_after, CAST(SUM(fixed) AS BIGINT) AS fixed, "
    "CAST(SUM(rejected) AS BIGINT) AS rejected FROM (" + " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", COUNT(*) AS rows_before,
            COUNT(*) FILTER (WHERE reject_reason = '') AS rows_after,
            COUNT(*) FILTER (WHERE changed AND reject_reason = '') AS fixed,
            COUNT(*) FILTER (WHERE reject_reason <> '') AS rejected FROM judged_{name}""" for name in CONTRACT)
    + ") AS counts GROUP BY ROLLUP (\"table\")"))
def cleaning_summary(ops):
    """Rows before, after, fixed and rejected per table and in total."""
    # The summary reads every table once, so only parents are written.
    return clean.summary(clean.judge(RawTables(ops), stage=True, keep=clean.VERDICTS, leaves=False))


def _left_sql() -> str:
    """Rows of the clean tables that still break a reject rule, counted rule by rule."""
    counts = []
    for name, table in CONTRACT.items():
        kept = f"(SELECT * FROM judged_{name} WHERE reject_reason = '')"
        counts += [f"SELECT COUNT(*) AS n FROM {kept} AS t WHERE v_{f.name} IS NULL" for f in table.fields if not f.optional]
        counts.append(f"SELECT COUNT(*) - COUNT(DISTINCT v_{table.key}) FROM {kept} AS t")
        counts += [f"SELECT COUNT(*) FROM {kept} AS t WHERE v_{column} IS NOT NULL AND v_{column} NOT IN "
                   f"(SELECT v_{CONTRACT[parent].key} FROM judged_{parent} WHERE reject_reason = '')"
                   for column, parent in table.parents.items()]
    return f"SELECT CAST(SUM(n) AS BIGINT) AS reject_findings FROM ({' UNION ALL '.join(counts)}) AS c"


@query("c17_clean_output_findings", with_ctes(_left_sql()))
def clean_output_findings(ops):
    """Reject findings left after cleaning; the gate requires none."""
    return clean.reject_findings(clean.clean(RawTables(ops), keep=clean.RETAINED).clean)

"""The raw tables, their findings and their judged rows as SQL, for the check queries."""

from __future__ import annotations

from harborline.catalog.ctes import define
from harborline.contract import CONTRACT, Table

define("raw_suppliers", """
SELECT s_suppkey + 2 AS source_row, CAST(s_suppkey AS VARCHAR) AS supplier_id,
       CASE WHEN s_suppkey % 23 = 4 THEN '   ' ELSE s_name END AS supplier_name,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_name || '@example.test' END AS contact_email,
       'C' || CAST(s_nationkey AS VARCHAR) AS country,
       CASE WHEN s_acctbal > 5000 THEN ' gold' ELSE 'standard' END AS supplier_tier
FROM supplier""")
define("raw_warehouses", """
SELECT CAST(n_nationkey + 2 AS BIGINT) AS source_row, CAST(n_nationkey AS VARCHAR) AS warehouse_id,
       n_name AS warehouse_name, n_name AS city,
       CASE WHEN n_nationkey % 7 = 0 THEN NULL ELSE r_name END AS region,
       CASE WHEN n_nationkey = 13 THEN '12.5' ELSE CAST(n_nationkey * 1000 AS VARCHAR) END AS capacity_units
FROM nation JOIN region ON r_regionkey = n_regionkey""")
define("raw_customers", """
SELECT c_custkey + 2 AS source_row, CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
       c_name || '@example.test' AS email,
       CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(c_custkey * 7 AS VARCHAR) END AS phone,
       'N' || CAST(c_nationkey AS VARCHAR) AS city, 'ST' AS state,
       CASE WHEN c_custkey % 71 = 0 THEN '2020-13-45'
            ELSE CAST(CAST(DATE '1994-01-01' + CAST(c_custkey % 900 AS INT) AS DATE) AS VARCHAR) END AS signup_date,
       c_mktsegment AS customer_segment
FROM customer""")
define("raw_employees", """
SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) + 1 AS source_row,
       o_orderpriority AS employee_id, 'Desk ' || o_orderpriority AS employee_name,
       'desk@example.test' AS email, CAST(NULL AS VARCHAR) AS phone, 'clerk' AS role,
       '2000-01-01' AS hire_date
FROM orders""")
define("raw_products", """
SELECT p_partkey + 2 AS source_row, CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
       'SKU-' || CAST(p_partkey AS VARCHAR) AS sku, p_brand AS sku_group,
       CASE WHEN p_partkey % 7 = 0 THEN lower(p_type) WHEN p_partkey % 11 = 0 THEN upper(p_type)
            ELSE upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) END AS category,
       CAST(p_partkey % 10 AS VARCHAR) AS supplier_id,
       (CASE WHEN p_partkey % 53 = 0 THEN '-' ELSE '' END)
           || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS unit_price,
       CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name END AS description
FROM part""")
define("raw_orders", """
SELECT o_orderkey + 2 AS source_row,
       CAST(CASE WHEN o_orderkey % 50 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS VARCHAR) AS order_id,
       CAST(CASE WHEN o_orderkey % 97 = 0 THEN o_custkey + 100000000 ELSE o_custkey END AS VARCHAR) AS customer_id,
       CAST(c_nationkey AS VARCHAR) AS warehouse_id, o_orderpriority AS employee_id,
       CASE WHEN o_orderkey % 89 = 0 THEN 'not-a-date' WHEN o_orderkey % 79 = 0 THEN NULL
            ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date,
       CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN '  note '
            ELSE 'note' END AS order_notes,
       CASE WHEN o_orderkey % 83 = 0 THEN '   ' WHEN o_orderstatus = 'F' THEN 'fulfilled'
            ELSE 'unfulfilled' END AS order_status
FROM orders JOIN customer ON c_custkey = o_custkey""")
define("raw_order_items", """
SELECT ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                          l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) + 1 AS source_row,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_item_id,
       CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
       CASE WHEN l_partkey % 101 = 0 THEN '2.5'
            ELSE (CASE WHEN l_partkey % 37 = 0 THEN '-' ELSE '' END) || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
            END AS quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS unit_price,
       CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'D' || CAST(l_linenumber AS VARCHAR) END AS discount_code
FROM lineitem""")
define("raw_deliveries", """
SELECT order_id * 1000000 + supplier_id + 2 AS source_row, delivery_id, CAST(order_id AS VARCHAR) AS order_id,
       CAST(supplier_id AS VARCHAR) AS supplier_id, CAST(warehouse_id AS VARCHAR) AS warehouse_id,
       CAST(shipped_date AS VARCHAR) AS shipped_date,
       CAST(CASE WHEN order_id % 29 = 0 AND delivered_date IS NOT NULL THEN CAST(shipped_date - 1 AS DATE)
                 ELSE delivered_date END AS VARCHAR) AS delivered_date,
       CAST(promised_delivery_date AS VARCHAR) AS promised_delivery_date,
       CASE WHEN order_id % 43 = 0 THEN 'maybe' WHEN order_id % 37 = 0 THEN ' True '
            WHEN supplier_late THEN 'true' ELSE 'false' END AS supplier_late,
       delivery_status,
       CASE WHEN supplier_id % 3 = 0 THEN NULL ELSE 'T' || delivery_id END AS tracking_number
FROM ops_deliveries""")
define("raw_inventory_snapshots", """
SELECT ROW_NUMBER() OVER (ORDER BY product_id, supplier_id, snapshot_date) + 1 AS source_row, snapshot_id,
       CAST(snapshot_date AS VARCHAR) AS snapshot_date, CAST(product_id AS VARCHAR) AS product_id,
       CAST(warehouse_id AS VARCHAR) AS warehouse_id, CAST(supplier_id AS VARCHAR) AS supplier_id,
       CASE WHEN product_id % 31 = 0 THEN '-3' ELSE CAST(quantity_on_hand AS VARCHAR) END AS quantity_on_hand,
       CAST(reorder_point AS VARCHAR) AS reorder_point,
       CASE WHEN product_id % 43 = 0 THEN 'yes' WHEN supplier_id % 17 = 0 AND stockout_flag THEN 'TRUE'
            WHEN stockout_flag THEN 'true' ELSE 'false' END AS stockout_flag,
       CASE WHEN product_id % 2 = 0 THEN NULL ELSE 'counted' END AS notes
FROM ops_inventory_snapshots""")
define("raw_support_tickets", """
SELECT ticket_id + 2 AS source_row, CAST(ticket_id AS VARCHAR) AS ticket_id,
       CAST(CASE WHEN ticket_id % 19 = 0 THEN customer_id + 100000000 ELSE customer_id END AS VARCHAR) AS customer_id,
       CAST(ticket_date AS VARCHAR) AS ticket_date,
       CASE WHEN ticket_id % 29 = 0 THEN ' ' || issue_type || ' ' ELSE issue_type END AS issue_type,
       priority, resolution_status,
       CASE WHEN ticket_id % 4 = 0 THEN NULL ELSE 'done' END AS resolution_notes
FROM ops_support_tickets""")


def trim_sql(column: str) -> str:
    return f"NULLIF(regexp_replace({column}, '^\\s+|\\s+$', '', 'g'), '')"


def typed_sql(text: str, kind: str) -> str:
    number = f"CASE WHEN regexp_full_match({text}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') " \
             f"THEN TRY_CAST({text} AS DOUBLE) END"
    return {
        "string": text,
        "number": number,
        "integer": f"CASE WHEN ({number}) % 1 = 0 THEN CAST({number} AS BIGINT) END",
        "boolean": f"CASE lower({text}) WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END",
        "date": f"CASE WHEN regexp_matches({text}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
                f"THEN TRY_CAST({text} AS DATE) END",
    }[kind]


def title_sql(text: str) -> str:
    """Title case for the ASCII words of the test data."""
    return (f"array_to_string(list_transform(regexp_extract_all(lower({text}), '[a-z]+|[^a-z]+'), "
            f"lambda w: upper(w[1:1]) || w[2:]), '')")


def findings_sql(table: Table, names: set[str]) -> str:
    """One SELECT per rule, united; columns as in the findings frame."""
    raw = f"raw_{table.name}"
    rules: list[tuple[str, str, str, str, str]] = []
    for f in table.fields:
        trimmed = trim_sql(f.name)
        if not f.optional:
            rules.append(("null_required", "reject", f.name, f"{f.name} IS NULL",
                          f"required values are null in {f.name}"))
        elif f.kind == "string":
            rules.append(("null_optional", "warn", f.name, f"{f.name} IS NULL",
                          f"optional values are null in {f.name}"))
        if f.kind != "string":
            rules.append(("invalid_type", "reject", f.name,
                          f"{f.name} IS NOT NULL AND ({typed_sql(trimmed, f.kind)}) IS NULL",
                          f"{f.name} has values of another type"))
    for c in table.non_negative:
        rules.append(("negative_value", "fix", c, f"({typed_sql(trim_sql(c), 'number')}) < 0",
                      f"{c} has negative values"))
    if table.title_cased:
        c = table.title_cased
        rules.append(("inconsistent_category_casing", "fix", c, f"{c} <> {title_sql(c)}",
                      f"{c} is not in title case"))
    if table.ordered_dates:
        a, b = table.ordered_dates
        rules.append(("delivered_before_shipped", "fix", b,
                      f"({typed_sql(trim_sql(b), 'date')}) < ({typed_sql(trim_sql(a), 'date')})",
                      f"{b} precedes the shipping date"))
    rules.append(("duplicate_primary_key", "reject", table.key,
                  f"{table.key} IS NOT NULL AND COUNT(*) OVER (PARTITION BY {table.key}) > 1",
                  f"{table.key} repeats a primary key"))
    for c, parent in table.parents.items():
        if parent in names:
            key = CONTRACT[parent].key
            rules.append(("foreign_key_not_found", "reject", c,
                          f"{c} IS NOT NULL AND {c} NOT IN (SELECT {key} FROM raw_{parent} WHERE {key} IS NOT NULL)",
                          f"{c} refers to rows that do not exist"))
    parts = [
        f"SELECT '{table.name}' AS \"table\", '{code}' AS code, '{severity}' AS severity, '{column}' AS \"column\", "
        f"COUNT(*) AS count, '{message}' AS message, "
        f"array_to_string(list_slice(list_sort(list(source_row - 1)), 1, 10), ',') AS sample_rows "
        f"FROM (SELECT source_row, {condition} AS bad FROM {raw}) AS marked WHERE bad HAVING COUNT(*) > 0"
        for code, severity, column, condition, message in rules
    ]
    return "\nUNION ALL\n".join(parts)


for _t in CONTRACT.values():
    define(f"findings_{_t.name}", findings_sql(_t, set(CONTRACT)))


def judged_sql(table: Table) -> str:
    """Raw columns, normalised ``v_`` columns, ``changed`` and ``reject_reason``."""
    trims = ", ".join(f"{trim_sql(f.name)} AS t_{f.name}" for f in table.fields)
    edges = " OR ".join(
        f"COALESCE({f.name} <> regexp_replace({f.name}, '^\\s+|\\s+$', '', 'g'), FALSE)" for f in table.fields
    )
    typed = ", ".join(f"{typed_sql('t_' + f.name, f.kind)} AS u_{f.name}" for f in table.fields)
    reasons = [f"CASE WHEN t_{f.name} IS NOT NULL AND u_{f.name} IS NULL THEN 'invalid_type:{f.name}' END"
               for f in table.fields if f.kind != "string"]
    reasons += [f"CASE WHEN u_{f.name} IS NULL THEN 'null_required:{f.name}' END"
                for f in table.fields if not f.optional]
    reasons += [f"CASE WHEN u_{c} < 0 THEN 'negative_value:{c}' END" for c in table.non_negative]
    if table.ordered_dates:
        a, b = table.ordered_dates
        reasons.append(f"CASE WHEN u_{b} < u_{a} THEN 'delivered_before_shipped' END")
    reasons.append(f"CASE WHEN u_{table.key} IS NOT NULL AND ROW_NUMBER() OVER (PARTITION BY u_{table.key} "
                   f"ORDER BY source_row) > 1 THEN 'duplicate_primary_key:{table.key}' END")
    joins = ""
    for c, parent in table.parents.items():
        orphan = f"'orphan_foreign_key:{c}'"
        if parent == "orders":
            orphan = f"CASE WHEN k_{c}.k IS NOT NULL THEN 'cascade_parent_order_rejected' ELSE {orphan} END"
        reasons.append(f"CASE WHEN u_{c} IS NOT NULL AND NOT COALESCE(k_{c}.kept, FALSE) THEN {orphan} END")
        key = CONTRACT[parent].key
        joins += (f" LEFT JOIN (SELECT u_{key} AS k, bool_or(reject_reason = '') AS kept FROM judged_{parent} "
                  f"GROUP BY 1) AS k_{c} ON k_{c}.k = u_{c}")
    values, changed = [], [f"({edges})"]
    for f in table.fields:
        value = f"u_{f.name}"
        if f.name == table.title_cased:
            changed.append(f"COALESCE({value} <> {title_sql(value)}, FALSE)")
            value = title_sql(value)
        if f.default is not None:
            changed.append(f"u_{f.name} IS NULL")
            value = f"COALESCE({value}, '{f.default}')"
        values.append(f"{value} AS v_{f.name}")
    return (f"SELECT typed.*, {', '.join(values)}, ({' OR '.join(changed)}) AS changed, "
            f"concat_ws('; ', {', '.join(reasons)}) AS reject_reason\n"
            f"FROM (SELECT *, {typed} FROM (SELECT *, {trims} FROM raw_{table.name}) AS trimmed) AS typed{joins}")


for _t in CONTRACT.values():
    define(f"judged_{_t.name}", judged_sql(_t))

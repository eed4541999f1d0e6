"""All-text raw tables with planted defects, derived from the star schema.

They play the part of a CSV bundle before validation. ``source_row`` is the line of
the row in such a file, the header being line 1. Defects depend on keys only.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.contract import CONTRACT
from harborline.functions.dates import compact_day_sql
from harborline.operators.ordering import dense_index
from harborline.operators.storage import staged
from harborline.sources.tables import OpsTables

# The order of lines as far as a raw table shows them: lines that agree in these columns give the same row.
LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


class RawTables(Mapping):
    """Mapping of contract table name to lazily built raw frame."""

    def __init__(self, ops: OpsTables):
        self.ops = ops
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in CONTRACT:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = getattr(self, f"_{name}")()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(CONTRACT)

    def __len__(self) -> int:
        return len(CONTRACT)

    def only(self, *names: str) -> dict[str, DataFrame]:
        return {name: self[name] for name in names}

    def numbered(self, *names: str) -> dict[str, DataFrame]:
        """Frames with ``data_row`` (first data row = 1), as validation counts rows."""
        return {
            name: self[name].withColumn("data_row", F.col("source_row") - 1).drop("source_row")
            for name in (names or CONTRACT)
        }

    def _suppliers(self) -> DataFrame:
        return self.ops.source("supplier").selectExpr(
            "s_suppkey + 2 AS source_row",
            "CAST(s_suppkey AS STRING) AS supplier_id",
            "CASE WHEN s_suppkey % 23 = 4 THEN '   ' ELSE s_name END AS supplier_name",
            "CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE concat(s_name, '@example.test') END AS contact_email",
            "concat('C', CAST(s_nationkey AS STRING)) AS country",
            "CASE WHEN s_acctbal > 5000 THEN ' gold' ELSE 'standard' END AS supplier_tier",
        )

    def _warehouses(self) -> DataFrame:
        return self.ops.source("nation").join(
            self.ops.source("region"), F.col("r_regionkey") == F.col("n_regionkey")
        ).selectExpr(
            "CAST(n_nationkey + 2 AS BIGINT) AS source_row",
            "CAST(n_nationkey AS STRING) AS warehouse_id",
            "n_name AS warehouse_name",
            "n_name AS city",
            "CASE WHEN n_nationkey % 7 = 0 THEN NULL ELSE r_name END AS region",
            "CASE WHEN n_nationkey = 13 THEN '12.5' ELSE CAST(n_nationkey * 1000 AS STRING) END AS capacity_units",
        )

    def _customers(self) -> DataFrame:
        return self.ops.source("customer").selectExpr(
            "c_custkey + 2 AS source_row",
            "CAST(c_custkey AS STRING) AS customer_id",
            "c_name AS customer_name",
            "concat(c_name, '@example.test') AS email",
            "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(c_custkey * 7 AS STRING) END AS phone",
            "concat('N', CAST(c_nationkey AS STRING)) AS city",
            "'ST' AS state",
            "CASE WHEN c_custkey % 71 = 0 THEN '2020-13-45' "
            "ELSE CAST(date_add(DATE'1994-01-01', CAST(c_custkey % 900 AS INT)) AS STRING) END AS signup_date",
            "c_mktsegment AS customer_segment",
        )

    def _employees(self) -> DataFrame:
        return self.ops.source("orders").select("o_orderpriority").distinct().selectExpr(
            "CAST(substr(o_orderpriority, 1, 1) AS BIGINT) + 1 AS source_row",
            "o_orderpriority AS employee_id",
            "concat('Desk ', o_orderpriority) AS employee_name",
            "'desk@example.test' AS email",
            "CAST(NULL AS STRING) AS phone",
            "'clerk' AS role",
            "'2000-01-01' AS hire_date",
        )

    def _products(self) -> DataFrame:
        return self.ops.source("part").selectExpr(
            "p_partkey + 2 AS source_row",
            "CAST(p_partkey AS STRING) AS product_id",
            "p_name AS product_name",
            "concat('SKU-', CAST(p_partkey AS STRING)) AS sku",
            "p_brand AS sku_group",
            "CASE WHEN p_partkey % 7 = 0 THEN lower(p_type) WHEN p_partkey % 11 = 0 THEN upper(p_type) "
            "ELSE concat(upper(substr(p_type, 1, 1)), lower(substr(p_type, 2))) END AS category",
            "CAST(p_partkey % 10 AS STRING) AS supplier_id",
            "concat(CASE WHEN p_partkey % 53 = 0 THEN '-' ELSE '' END, "
            "CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING)) AS unit_price",
            "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name END AS description",
        )

    def _orders(self) -> DataFrame:
        place = self.ops.source("customer").selectExpr("c_custkey AS o_custkey", "c_nationkey")
        # Staged, because judging and validating read the table several times.
        orders = staged(self.ops.source("orders").join(place, "o_custkey").select(
            "o_orderkey", "o_custkey", "c_nationkey", "o_orderpriority", "o_orderdate", "o_orderstatus"), "orders")
        return orders.selectExpr(
            "o_orderkey + 2 AS source_row",
            "CAST(CASE WHEN o_orderkey % 50 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS STRING) AS order_id",
            "CAST(CASE WHEN o_orderkey % 97 = 0 THEN o_custkey + 100000000 ELSE o_custkey END AS STRING) "
            "AS customer_id",
            "CAST(c_nationkey AS STRING) AS warehouse_id",
            "o_orderpriority AS employee_id",
            "CASE WHEN o_orderkey % 89 = 0 THEN 'not-a-date' WHEN o_orderkey % 79 = 0 THEN NULL "
            "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS order_date",
            "CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN '  note ' "
            "ELSE 'note' END AS order_notes",
            "CASE WHEN o_orderkey % 83 = 0 THEN '   ' WHEN o_orderstatus = 'F' THEN 'fulfilled' "
            "ELSE 'unfulfilled' END AS order_status",
        )

    def _order_items(self) -> DataFrame:
        lines = dense_index(self.ops.source("lineitem").select(*LINE_ORDER), LINE_ORDER, "position")
        return lines.selectExpr(
            "position + 2 AS source_row",
            "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS order_item_id",
            "CAST(l_orderkey AS STRING) AS order_id",
            "CAST(l_partkey AS STRING) AS product_id",
            "CASE WHEN l_partkey % 101 = 0 THEN '2.5' ELSE concat(CASE WHEN l_partkey % 37 = 0 THEN '-' "
            "ELSE '' END, CAST(CAST(l_quantity AS BIGINT) AS STRING)) END AS quantity",
            "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) AS unit_price",
            "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE concat('D', CAST(l_linenumber AS STRING)) END "
            "AS discount_code",
        )

    def _deliveries(self) -> DataFrame:
        # Staged like the orders; its two shuffles are not repeated for every reader.
        return staged(self.ops["deliveries"], "deliveries").selectExpr(
            "order_id * 1000000 + supplier_id + 2 AS source_row",
            "delivery_id",
            "CAST(order_id AS STRING) AS order_id",
            "CAST(supplier_id AS STRING) AS supplier_id",
            "CAST(warehouse_id AS STRING) AS warehouse_id",
            "CAST(shipped_date AS STRING) AS shipped_date",
            "CAST(CASE WHEN order_id % 29 = 0 AND delivered_date IS NOT NULL THEN date_add(shipped_date, -1) "
            "ELSE delivered_date END AS STRING) AS delivered_date",
            "CAST(promised_delivery_date AS STRING) AS promised_delivery_date",
            "CASE WHEN order_id % 43 = 0 THEN 'maybe' WHEN order_id % 37 = 0 THEN ' True ' "
            "WHEN supplier_late THEN 'true' ELSE 'false' END AS supplier_late",
            "delivery_status",
            "CASE WHEN supplier_id % 3 = 0 THEN NULL ELSE concat('T', delivery_id) END AS tracking_number",
        )

    def _inventory_snapshots(self) -> DataFrame:
        order = ("product_id", "supplier_id", "snapshot_date")
        snapshot_id = f"concat_ws('-', CAST(product_id AS STRING), CAST(supplier_id AS STRING), {compact_day_sql('snapshot_date')})"
        # Identities and marks follow from the other columns, so they are not shuffled. Sampling the range bounds reads
        # the shuffled levels again, not the lines.
        snapshots = self.ops["inventory_snapshots"].drop("snapshot_id")
        return dense_index(snapshots, order, "position").selectExpr(
            "position + 2 AS source_row",
            f"{snapshot_id} AS snapshot_id",
            "CAST(snapshot_date AS STRING) AS snapshot_date",
            "CAST(product_id AS STRING) AS product_id",
            "CAST(warehouse_id AS STRING) AS warehouse_id",
            "CAST(supplier_id AS STRING) AS supplier_id",
            "CASE WHEN product_id % 31 = 0 THEN '-3' ELSE CAST(quantity_on_hand AS STRING) END "
            "AS quantity_on_hand",
            "CAST(reorder_point AS STRING) AS reorder_point",
            "CASE WHEN product_id % 43 = 0 THEN 'yes' WHEN supplier_id % 17 = 0 AND stockout_flag THEN 'TRUE' "
            "WHEN stockout_flag THEN 'true' ELSE 'false' END AS stockout_flag",
            "CASE WHEN product_id % 2 = 0 THEN NULL ELSE 'counted' END AS notes",
        )

    def _support_tickets(self) -> DataFrame:
        return self.ops["support_tickets"].selectExpr(
            "ticket_id + 2 AS source_row",
            "CAST(ticket_id AS STRING) AS ticket_id",
            "CAST(CASE WHEN ticket_id % 19 = 0 THEN customer_id + 100000000 ELSE customer_id END AS STRING) "
            "AS customer_id",
            "CAST(ticket_date AS STRING) AS ticket_date",
            "CASE WHEN ticket_id % 29 = 0 THEN concat(' ', issue_type, ' ') ELSE issue_type END AS issue_type",
            "priority",
            "resolution_status",
            "CASE WHEN ticket_id % 4 = 0 THEN NULL ELSE 'done' END AS resolution_notes",
        )

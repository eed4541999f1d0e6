"""Operational tables read from a star-schema Parquet folder.

Each table is derived on first use, so a query scans only what it needs. Several
attributes have no counterpart in the source and are derived from other columns;
they only have to be deterministic.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from harborline.functions.dates import compact_day_sql
from harborline.operators.joins import fact_join


# Schemas already read from Parquet footers, by (session, path).
_SCHEMAS: dict[tuple[str, str], StructType] = {}


class OpsTables(Mapping):
    """Mapping of operational table name to lazily built frame."""

    NAMES = (
        "warehouses", "suppliers", "products", "customers", "orders", "order_headers",
        "order_lines", "supplier_marks", "order_items", "deliveries", "inventory_snapshots", "support_tickets",
    )

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._sources: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        """One source table."""
        if name not in self._sources:
            path = f"{self.folder}/{name}.parquet"
            key = (self.spark.sparkContext.applicationId, path)
            if key not in _SCHEMAS:
                _SCHEMAS[key] = self.spark.read.parquet(path).schema
            self._sources[name] = self.spark.read.schema(_SCHEMAS[key]).parquet(path)
        return self._sources[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        if name not in self._tables:
            self._tables[name] = getattr(self, f"_{name}")()
        return self._tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)

    def _warehouses(self) -> DataFrame:
        return self.source("nation").join(
            self.source("region"), F.col("r_regionkey") == F.col("n_regionkey")
        ).select(
            F.col("n_nationkey").cast("bigint").alias("warehouse_id"),
            F.col("n_name").alias("warehouse_name"),
            F.col("r_name").alias("region"),
        )

    def _suppliers(self) -> DataFrame:
        return self.source("supplier").select(
            F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name")
        )

    def _products(self) -> DataFrame:
        return self.source("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("sku_group"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").cast("decimal(12,2)").alias("unit_price"),
            F.col("p_size").cast("bigint").alias("reorder_point"),
        )

    def _customers(self) -> DataFrame:
        first_order = self.source("orders").groupBy("o_custkey").agg(
            F.min("o_orderdate").cast("date").alias("signup_date")
        )
        return self.source("customer").join(
            first_order, F.col("o_custkey") == F.col("c_custkey"), "left"
        ).select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("customer_segment"),
            "signup_date",
        )

    def _order_headers(self) -> DataFrame:
        """Orders without the warehouse, for plans that never look at it."""
        return self.source("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderpriority").alias("employee_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.when(F.col("o_orderstatus") == "F", "fulfilled").otherwise("unfulfilled")
            .alias("order_status"),
        )

    def _orders(self) -> DataFrame:
        place = self.source("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_nationkey").cast("bigint").alias("warehouse_id"),
        )
        return self["order_headers"].join(place, "customer_id").select(
            "order_id", "customer_id", "warehouse_id", "employee_id", "order_date", "order_status"
        )

    def _order_lines(self) -> DataFrame:
        """Order items without the price, for plans that never look at it."""
        return self.source("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
        )

    def _order_items(self) -> DataFrame:
        price = self["products"].select("product_id", "unit_price")
        return self["order_lines"].join(price, "product_id").select(
            "order_id", "product_id", "quantity", "unit_price")

    def _supplier_marks(self) -> DataFrame:
        """Deliveries with supplier and lateness only, for plans that need neither place nor dates."""
        return self.source("lineitem").groupBy(
            F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("supplier_id")
        ).agg(F.max(F.col("l_returnflag") == "R").alias("supplier_late"))

    def shipped(self) -> DataFrame:
        """The lines of an order that a supplier ships, at most one row for both; marks and deliveries follow from it."""
        return self.source("lineitem").groupBy(
            F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("supplier_id")
        ).agg(
            F.max("l_linenumber").alias("last_line"),
            F.max("l_quantity").alias("most"),
            F.max(F.col("l_returnflag") == "R").alias("supplier_late"),
        )

    def deliveries_of(self, shipped: DataFrame) -> DataFrame:
        """Deliveries out of ``shipped``, which may be stored."""
        lag = (F.col("last_line") + F.col("warehouse_id") % 4).cast("int")
        transit = F.col("most").cast("int") % 9 + 1
        done = F.col("order_status") == "fulfilled"
        return fact_join(self["orders"], shipped, "order_id").select(
            F.concat_ws("-", F.col("order_id").cast("string"), F.col("supplier_id").cast("string"))
            .alias("delivery_id"),
            "order_id",
            "supplier_id",
            "warehouse_id",
            F.date_add("order_date", lag).alias("shipped_date"),
            F.when(done, F.date_add("order_date", lag + transit)).alias("delivered_date"),
            F.date_add("order_date", 14).alias("promised_delivery_date"),
            "supplier_late",
            F.when(done, "delivered").otherwise("backordered").alias("delivery_status"),
        )

    def _deliveries(self) -> DataFrame:
        # Reduced before the join: an order has at most one row per supplier here.
        return self.deliveries_of(self.shipped())

    def _inventory_snapshots(self) -> DataFrame:
        levels = self.source("lineitem").groupBy("l_partkey", "l_suppkey", "l_shipdate").agg(
            F.min("l_quantity").alias("least")
        )
        empty = F.col("least") <= 5
        return (
            levels
            .join(self.source("supplier").select("s_suppkey", "s_nationkey"),
                  F.col("s_suppkey") == F.col("l_suppkey"))
            .join(self.source("part").select("p_partkey", "p_size"),
                  F.col("p_partkey") == F.col("l_partkey"))
            .select(
                F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                            F.expr(compact_day_sql("CAST(l_shipdate AS DATE)"))).alias("snapshot_id"),
                F.col("l_shipdate").cast("date").alias("snapshot_date"),
                F.col("l_partkey").alias("product_id"),
                F.col("s_nationkey").cast("bigint").alias("warehouse_id"),
                F.col("l_suppkey").alias("supplier_id"),
                F.when(empty, F.lit(0)).otherwise(F.col("least").cast("bigint")).cast("bigint")
                .alias("quantity_on_hand"),
                F.col("p_size").cast("bigint").alias("reorder_point"),
                empty.alias("stockout_flag"),
            )
        )

    def _support_tickets(self) -> DataFrame:
        return self.source("events").select(
            F.col("event_id").alias("ticket_id"),
            F.col("user_id").alias("customer_id"),
            F.col("ts").cast("date").alias("ticket_date"),
            F.col("event_type").alias("issue_type"),
            F.when(F.col("value") >= 100, "high").when(F.col("value") >= 30, "medium")
            .otherwise("low").alias("priority"),
            F.when(F.col("event_id") % 8 == 0, "open").otherwise("resolved")
            .alias("resolution_status"),
        )

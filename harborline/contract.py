"""The data contract: what each source table must look like.

Column kinds, keys and rules are declared here once; validation, cleaning and the
published-layer checks all read them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

REJECT, FIX, WARN = "reject", "fix", "warn"
SEVERITIES = (REJECT, FIX, WARN)


@dataclass(frozen=True)
class Field:
    """One column: its kind and whether it may be empty."""

    name: str
    kind: str = "string"
    optional: bool = False
    default: str | None = None

    @property
    def spark_type(self) -> T.DataType:
        return {
            "string": T.StringType(),
            "integer": T.LongType(),
            "number": T.DecimalType(12, 2),
            "boolean": T.BooleanType(),
            "date": T.DateType(),
        }[self.kind]


@dataclass(frozen=True)
class Table:
    """One table; the first field is its primary key."""

    name: str
    fields: tuple[Field, ...]
    parents: Mapping[str, str] = field(default_factory=dict)  # column -> parent table
    non_negative: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()  # published layer only
    not_before_1900: tuple[str, ...] = ()  # published layer only
    title_cased: str | None = None
    ordered_dates: tuple[str, str] | None = None  # (must not follow, must not precede)

    @property
    def key(self) -> str:
        return self.fields[0].name

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.fields])

    @property
    def typed_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type) for f in self.fields])


def _text(*names: str) -> tuple[Field, ...]:
    return tuple(Field(n) for n in names)


def _note(name: str, default: str) -> Field:
    return Field(name, optional=True, default=default)


# Tables in load order (parents first), their columns, kinds, keys,
# rules, and the defaults that replace empty optional text.
CONTRACT: dict[str, Table] = {t.name: t for t in (
    Table(
        "suppliers",
        (*_text("supplier_id", "supplier_name"), _note("contact_email", "Not provided"),
         *_text("country", "supplier_tier")),
    ),
    Table(
        "warehouses",
        (*_text("warehouse_id", "warehouse_name", "city"), _note("region", "Unassigned"),
         Field("capacity_units", "integer")),
        non_negative=("capacity_units",),
    ),
    Table(
        "customers",
        (*_text("customer_id", "customer_name", "email"), _note("phone", "Unknown"),
         *_text("city", "state"), Field("signup_date", "date"), *_text("customer_segment")),
        not_before_1900=("signup_date",),
    ),
    Table(
        "employees",
        (*_text("employee_id", "employee_name", "email"), _note("phone", "Unknown"),
         *_text("role"), Field("hire_date", "date")),
        not_before_1900=("hire_date",),
    ),
    Table(
        "products",
        (*_text("product_id", "product_name", "sku", "sku_group", "category", "supplier_id"),
         Field("unit_price", "number"), _note("description", "Not provided")),
        parents={"supplier_id": "suppliers"},
        non_negative=("unit_price",),
        title_cased="category",
    ),
    Table(
        "orders",
        (*_text("order_id", "customer_id", "warehouse_id", "employee_id"),
         Field("order_date", "date"), _note("order_notes", "Not provided"), *_text("order_status")),
        parents={"customer_id": "customers", "warehouse_id": "warehouses", "employee_id": "employees"},
        not_before_1900=("order_date",),
    ),
    Table(
        "order_items",
        (*_text("order_item_id", "order_id", "product_id"), Field("quantity", "integer"),
         Field("unit_price", "number"), _note("discount_code", "NONE")),
        parents={"order_id": "orders", "product_id": "products"},
        non_negative=("quantity", "unit_price"),
        positive=("quantity",),
    ),
    Table(
        "deliveries",
        (*_text("delivery_id", "order_id", "supplier_id", "warehouse_id"),
         Field("shipped_date", "date"), Field("delivered_date", "date", optional=True),
         Field("promised_delivery_date", "date"), Field("supplier_late", "boolean"),
         *_text("delivery_status"), _note("tracking_number", "Not provided")),
        parents={"order_id": "orders", "supplier_id": "suppliers", "warehouse_id": "warehouses"},
        ordered_dates=("shipped_date", "delivered_date"),
    ),
    Table(
        "inventory_snapshots",
        (*_text("snapshot_id"), Field("snapshot_date", "date"),
         *_text("product_id", "warehouse_id", "supplier_id"),
         Field("quantity_on_hand", "integer"), Field("reorder_point", "integer"),
         Field("stockout_flag", "boolean"), _note("notes", "Not provided")),
        parents={"product_id": "products", "warehouse_id": "warehouses", "supplier_id": "suppliers"},
        non_negative=("quantity_on_hand", "reorder_point"),
    ),
    Table(
        "support_tickets",
        (*_text("ticket_id", "customer_id"), Field("ticket_date", "date"),
         *_text("issue_type", "priority", "resolution_status"),
         _note("resolution_notes", "Not provided")),
        parents={"customer_id": "customers"},
    ),
)}

# Children of this table report a rejected parent as a cascade, not as an orphan.
CASCADING_PARENT = "orders"


def known(names) -> None:
    """Refuse table names outside the contract."""
    unknown = sorted(set(names) - set(CONTRACT))
    if unknown:
        raise ValueError("unknown source tables: " + ", ".join(unknown))

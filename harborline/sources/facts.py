"""Facts published by bucket of their order, so that plans over orders join without a shuffle.

Orders, items and deliveries lie in as many buckets of ``order_id``, one file each, sorted. Joins on the order, and groupings by
it or by it and more, then read bucket by bucket. A bucket is what a task reads, so choose their number by the size of
the largest table, as ``session.shuffle_partitions`` does for shuffles.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame

KEY = "order_id"
FACTS = ("orders", "order_items", "deliveries")


def publish_facts(ops: Mapping[str, DataFrame], target: str, buckets: int, prefix: str | None = None) -> dict[str, str]:
    """Write the facts below ``target`` and enter them in the session's catalog; catalog name by table."""
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    prefix = prefix or f"facts_{uuid.uuid4().hex}_"
    for name in FACTS:
        # The shuffle deals rows to tasks as the writer deals them to buckets, so a task writes one file.
        dealt = ops[name].repartition(buckets, KEY)
        dealt.write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY).option(
            "path", f"{target.rstrip('/')}/{name}").saveAsTable(f"{prefix}{name}")
    return {name: f"{prefix}{name}" for name in FACTS}


class BucketedFacts(Mapping):
    """Operational tables whose facts are read from their buckets; the others come from ``ops``."""

    def __init__(self, ops: Mapping[str, DataFrame], target: str, buckets: int):
        self.ops = ops
        names = publish_facts(ops, target, buckets)
        spark = ops["orders"].sparkSession
        facts = {name: spark.table(known) for name, known in names.items()}
        self.tables = {
            **facts,
            "order_headers": facts["orders"].drop("warehouse_id"),
            "order_lines": facts["order_items"].select(KEY, "product_id", "quantity"),
            "supplier_marks": facts["deliveries"].select(KEY, "supplier_id", "supplier_late"),
        }

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name] if name in self.tables else self.ops[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.ops)

    def __len__(self) -> int:
        return len(self.ops)

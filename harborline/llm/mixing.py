"""Mixing sources to target weights.

Words are summed per source. Every source has a weight and the targets share the whole
size of the corpus by weight, but no target exceeds ``cap`` times its source; what is cut
off is shared again by weight among the rest until no target is above. The target over
the size is the repetition rate: a document is emitted floor(rate) times, and once more
when a uniform number from the hash of its id is below the fraction.

The sources are one row each after a partially aggregated sum, and are numbered in order
by a range partition, so nothing assumes that they are few. Resharing runs one small
aggregate per round and brings two numbers to the driver. Documents meet their source in
a join of stored frames, which the planner broadcasts when small and otherwise lets
adaptive execution split where one source is hot.

Defined results: a null text has no words; a null source is a source of its own, last in
order; a source without words has target 0 and its documents are emitted 0 times; rows
with equal ids draw equal numbers, a row without an id draws by the hash of its text; an empty
table gives an empty result. Numbers do not depend on partitioning, so reruns agree. The words of very long texts
are all counted. Other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.frames import packed, staged, text_of, unpacked, words
from harborline.operators.ordering import dense_index

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source``, ``source_size``, ``target`` from rows of ``source`` and ``size``."""
    totals = staged(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    order = [F.col("source").asc_nulls_last()]
    placed = dense_index(totals, order, "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    pool = staged(placed.select("source", "source_size", weight.cast("bigint").alias("weight")), "pool")
    bound = cap * F.col("source_size")
    wide = "decimal(38,0)"  # products of a size and a sum of weights may exceed 64 bits
    # Shares are size * weight / weights with both whole numbers, so rounding cannot accumulate.
    total = pool.agg(F.sum("source_size")).first()[0] or 0
    left, shares = total, 0
    open_ = F.lit(True)
    while True:
        row = pool.filter(open_).agg(F.sum("weight"), F.count(F.lit(1))).first()
        shares = row[0] or 0
        if not shares:
            break
        above = bound.cast(wide) * F.lit(shares).cast(wide) < F.col("weight").cast(wide) * F.lit(left).cast(wide)
        cut = pool.filter(open_ & above).agg(F.sum(bound), F.count(F.lit(1))).first()
        if not cut[1]:
            break
        # What stands at its bound leaves the pool; the others share the rest.
        open_ = open_ & ~above
        left -= cut[0]
    share = F.when(open_, (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(shares or 1)))
    target = share.otherwise(bound.cast("double")).alias("target")
    return pool.select("source", "source_size", target)


def drawn_by(id_: Column, text: Column) -> Column:
    """What a row's number is drawn by: its id, or its text where it has none."""
    return F.coalesce(id_.cast("string"), F.md5(text))


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number from 0 to 1 that depends on the key and the seed alone."""
    digest = F.md5(F.concat(key, F.lit(":" + seed)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def _with_copies(rows: DataFrame, targets: DataFrame, seed: str) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` to rows with ``_source`` and ``_draw``."""
    joined = rows.join(targets, rows["_source"].eqNullSafe(targets["source"])).drop("source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + F.when(uniform(F.col("_draw"), seed) < rate - F.floor(rate), 1).otherwise(0)
    return joined.withColumn("copies", copies.cast("bigint"))


def _sized(docs: DataFrame, text_column: str, source_column: str) -> DataFrame:
    return docs.select(F.col(source_column).alias("source"),
                       F.size(words(text_of(text_column))).cast("bigint").alias("size"))


def mix_plan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
             weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target``, ``taken``, ``copies``."""
    narrow = staged(
        docs.select(F.col(id_column).alias("_id"), F.col(source_column).alias("_source"),
                    drawn_by(F.col(id_column), text_of(text_column)).alias("_draw"),
                    F.size(words(text_of(text_column))).cast("bigint").alias("_size")), "sizes")
    sizes = narrow.select(F.col("_source").alias("source"), F.col("_size").alias("size"))
    targets = staged(source_targets(sizes, weights, cap), "targets")
    out = _with_copies(narrow, targets, seed)
    return out.select(F.col("_id").alias(id_column), F.col("_size").alias("size"), "source_size", "target",
                      (F.col("_size") * F.col("copies")).alias("taken"), "copies")


def mixed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
          weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns."""
    targets = staged(source_targets(_sized(docs, text_column, source_column), weights, cap), "targets")
    rows = packed(docs, _source=F.col(source_column), _draw=drawn_by(F.col(id_column), text_of(text_column)))
    out = _with_copies(rows, targets, seed).filter("copies > 0")
    return unpacked(out.select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))))

"""Exact sets of keys as bitmaps.

Whole-number keys are kept as one bit each, in words of 64 of them, so a dense set is a small part of the size of
its keys in a join, a sparse one no larger than them, and it stays below the broadcast limit for far more of them. Rows are then marked as
members where they lie; the planner shuffles them only if even the bitmaps are too large. Text keys that are plain whole
numbers (no sign but minus, no leading zeros) use the bitmaps too, every other text is compared as it is. Nothing is approximate.

A null key is in no set. Repeated keys count once; an empty set has no members.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.operators.storage import staged

WORD_BITS = 6  # the bits of a key that find its place in a word
WORD = "bit_or(shiftleft(1L, CAST(_n & 63 AS INT)))"
BROADCAST_WORDS = 1 << 22  # words that are broadcast at most, a quarter of a GB in a join


def _word(number: str) -> Column:
    return F.shiftright(number, WORD_BITS).alias("bucket")


def _number(column: Column, kind: T.DataType) -> Column:
    """The key as a whole number, null where it is not written as one."""
    if not isinstance(kind, T.StringType):
        return column.cast("bigint")
    return F.when(column.rlike("^(0|-?[1-9][0-9]{0,17})$"), column).cast("bigint")


def _once(value: Column) -> Column:
    """``parsing.once_sql`` of a column."""
    return F.when(F.spark_partition_id() >= 0, value)


def repeated(keys: DataFrame, column: str) -> DataFrame:
    """Rows of ``keys`` whose key another row has too; rows without a key are left out.

    Only the hashes of the keys are shuffled, each row's once. Those found twice are written, so that their size decides how
    they meet the rows again, and the few rows that have them are compared by the key itself.
    """
    return _repeated_with_hash(keys, column).drop("_hash")


def _repeated_with_hash(keys: DataFrame, column: str) -> DataFrame:
    """Rows whose hash of the key another row has; almost always the key too."""
    known = keys.withColumn(column, _once(F.col(column))).filter(F.col(column).isNotNull())
    hashed = known.select("*", F.xxhash64(column).alias("_hash"))
    # Counting needs no memory per row, so the rows of a frequent key may meet in a task.
    twice = hashed.select("_hash").repartition("_hash").groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    twice = staged(twice.filter("_n > 1").select("_hash"), "repeated")
    return hashed.join(twice, "_hash", "left_semi")


def after_first(keys: DataFrame, column: str, order: str) -> DataFrame:
    """``order`` of the rows whose key another row of a lesser ``order`` has too; only narrow rows are shuffled."""
    found = _repeated_with_hash(keys.select(order, column), column)
    # Rows that met by their hashes stay where they are.
    first = F.min(order).over(Window.partitionBy("_hash", column))
    return found.select(order, first.alias("_first")).filter(F.col(order) > F.col("_first")).select(order)


def repeated_numbers(df: DataFrame, column: str) -> DataFrame | None:
    """The whole numbers that several rows have, each once; none if there are none.

    Rows are counted by words, so dense numbers are reduced before they are shuffled. Words with more rows than bits are
    looked at number by number.
    """
    numbers = df.select(F.col(column).cast("bigint").alias("_n")).filter("_n IS NOT NULL").select("_n", _word("_n"))
    counted = numbers.groupBy("bucket").agg(F.expr(WORD).alias("bits"), F.count(F.lit(1)).alias("_rows"))
    crowded = staged(counted.filter("_rows > bit_count(bits)").select("bucket"), "crowded")
    if crowded.isEmpty():
        return None
    several = numbers.join(crowded, "bucket", "left_semi").groupBy("_n").agg(F.count(F.lit(1)).alias("_rows"))
    return staged(several.filter("_rows > 1").select(F.col("_n").alias(column)), "repeated-numbers")


def key_bitmaps(keys: DataFrame, column: str) -> DataFrame:
    """Stored rows of ``bucket`` and ``bits``, a word with a bit for each of its whole-number keys; empty words are left out."""
    number = _number(F.col(column), keys.schema[column].dataType)
    known = keys.select(_once(number).alias("_n")).filter("_n IS NOT NULL")
    return staged(known.groupBy(_word("_n")).agg(F.expr(WORD).alias("bits")), "bitmaps")


@dataclass(frozen=True)
class KeySet:
    """A stored set of keys that rows are compared with: the words of its whole numbers, and its other texts if it has any."""

    words: DataFrame
    texts: DataFrame | None
    kind: T.DataType


def key_set(keys: DataFrame, key: str) -> KeySet:
    """The set of ``keys[key]``, for any number of comparisons.

    Up to ``BROADCAST_WORDS`` words are broadcast, so the rows compared with them are not shuffled; of larger sets the
    planner decides.
    """
    kind, texts = keys.schema[key].dataType, None
    words = key_bitmaps(keys, key)
    if words.count() <= BROADCAST_WORDS:
        words = F.broadcast(words)
    if isinstance(kind, T.StringType):
        other = F.when(_number(F.col(key), kind).isNull(), F.col(key))
        texts = staged(keys.select(_once(other).alias("_text")).filter("_text IS NOT NULL").distinct(), "texts")
        texts = None if texts.isEmpty() else texts
    return KeySet(words, texts, kind)


def with_members(df: DataFrame, column: str, keys: KeySet, out: str) -> DataFrame:
    """Add ``out``, whether the value of ``column`` is in a set; order and number of rows stay."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType) != isinstance(keys.kind, T.StringType):
        raise ValueError(f"{column} and the keys it is compared with are of different kinds")
    words = keys.words.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    marked = df.withColumn("_n", _number(F.col(column), kind)).withColumn("_at", F.shiftright("_n", WORD_BITS))
    marked = marked.join(words, F.col("_at") == F.col("_bucket"), "left")
    member = F.expr("coalesce(shiftright(_bits, CAST(_n & 63 AS INT)) & 1L, 0L) = 1L")
    if keys.texts is not None:
        marked = marked.join(keys.texts, F.when(F.col("_n").isNull(), F.col(column)) == F.col("_text"), "left")
        member = member | F.col("_text").isNotNull()
    return marked.withColumn(out, member).select(*df.columns, out)


def with_membership(df: DataFrame, column: str, keys: DataFrame, key: str, out: str) -> DataFrame:
    """Add ``out``, whether the value of ``column`` occurs among ``keys[key]``; order and number of rows stay."""
    if isinstance(df.schema[column].dataType, T.StringType) != isinstance(keys.schema[key].dataType, T.StringType):
        raise ValueError(f"{column} and {key} are of different kinds")
    return with_members(df, column, key_set(keys, key), out)


def orphans(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows with a value in ``column`` that ``keys[key]`` lacks."""
    found = with_membership(df.filter(F.col(column).isNotNull()), column, keys, key, "_member")
    return found.filter("NOT _member").drop("_member")

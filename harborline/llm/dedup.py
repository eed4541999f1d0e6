"""Exact deduplication by content hash.

Rows are grouped by the 128-bit MD5 of their text. Hashes that occur more than once are
then compared byte by byte: the least and the greatest text of a hash group are equal
exactly when all are. A hash whose texts differ is split by the text itself, so a
collision can neither join nor drop different texts.

Only narrow rows (id, hashes) are grouped and joined. Counts and extremes are combined
before the shuffle, so a group with a third of all rows sends one row for each input
partition; the join that returns the group to its members reads two stored frames, which
lets adaptive execution split a hot hash.

Defined results: a null text equals the empty text. A null id sorts below every other.
Rows that repeat both id and text count separately and exactly one of them stays. An
empty table gives an empty result. Very long texts are hashed and compared whole. Columns other than id and
text play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.frames import packed, staged, text_of, unpacked

KEY = ["hash", "exact"]


def content_hash(text: Column) -> Column:
    """The 128 bits that rows are grouped by first."""
    return F.unhex(F.md5(text))


def _collided(docs: DataFrame, id_column: str, text_column: str, repeated: DataFrame) -> DataFrame:
    """Hashes that stand for more than one text; practically always empty."""
    texts = docs.select(content_hash(text_of(text_column)).alias("hash"), text_of(text_column).alias("t"))
    extremes = texts.join(repeated, "hash", "left_semi").groupBy("hash").agg(
        F.min("t").alias("low"), F.max("t").alias("high"))
    return staged(extremes.filter("low <> high").select("hash", F.lit(True).alias("collides")), "collided")


def _members(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Stored narrow rows: id, content key and a number of the row."""
    text = text_of(text_column)
    narrow = staged(
        docs.select(
            F.col(id_column).alias("id"),
            content_hash(text).alias("hash"),
            F.unhex(F.sha2(text, 256)).alias("sha"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "content",
    )
    repeated = staged(narrow.groupBy("hash").count().filter("count > 1").select("hash"), "repeated")
    bad = _collided(docs, id_column, text_column, repeated)
    marked = narrow.join(bad, "hash", "left")
    # The text of a collided row is replaced by its SHA-256, which tells such texts apart.
    return marked.select("id", "hash", "sha", "number", F.when(F.col("collides"), F.col("sha")).otherwise(
        F.lit(b"")).alias("exact"))


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    The row with the largest id of each group stays.
    """
    members = _members(docs, id_column, text_column)
    # Largest id first, then the first of repeated rows.
    best = F.max(F.struct("id", (-F.col("number")).alias("last"))).alias("best")
    groups = staged(members.groupBy(*KEY).agg(F.count(F.lit(1)).alias("group_size"), best), "groups")
    return members.join(groups, KEY).select(
        F.col("id").alias(id_column),
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("number") == -F.col("best.last")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _own(id_column: str):
    """The id as a non-null key."""
    return F.coalesce(F.concat(F.lit("="), F.col(id_column).cast("string")), F.lit("null"))


def drop_exact(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    groups = exact_groups(docs, id_column, text_column)
    kept = groups.filter("kept").select(_own(id_column).alias("_id"), F.unhex("text_sha256").alias("_sha"))
    rows = packed(docs, _id=_own(id_column), _sha=F.unhex(F.sha2(text_of(text_column), 256)))
    # Rows that repeat id and text are both found; one of them stays.
    return unpacked(rows.join(staged(kept, "kept"), ["_id", "_sha"], "left_semi").dropDuplicates(["_id", "_sha"]))

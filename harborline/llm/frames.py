"""Helpers shared by the operators: clash-proof columns, words, staging."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.operators.storage import staged
from harborline.session import tune

__all__ = ["BLANK", "documents", "packed", "sampled", "staged", "table", "text_of", "tuned", "unpacked", "words"]

ROOT = str(Path(__file__).resolve().parents[2])
BLANK = " \t\n\x0b\f\r"  # the bytes 0x20 and 0x09 to 0x0D


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a folder, whole."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """All columns inside one struct ``_row`` beside ``columns``, so that no names can clash."""
    quoted = [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]
    return df.select(F.struct(*quoted).alias("_row"), *[c.alias(name) for name, c in columns.items()])


def unpacked(df: DataFrame) -> DataFrame:
    """The original columns of a packed frame."""
    return df.select("_row.*")


def text_of(column: str = "text") -> Column:
    """The text, null taken as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters other than the six blanks, in order."""
    inner = F.btrim(text, F.lit(BLANK))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+", -1))


def sampled(df: DataFrame, rows: int, total: int, *keys: str) -> DataFrame:
    """About ``rows`` of ``total`` rows, the same ones in every run: those whose hash of ``keys`` is low."""
    if rows >= total:
        return df
    cut = int(rows / total * (1 << 62))
    return df.filter(F.pmod(F.xxhash64(*keys), F.lit(1 << 62)) < F.lit(cut))


def tuned(spark: SparkSession) -> SparkSession:
    """Session settings of the library, and small Arrow batches, since a row may hold a long text.

    Workers look for the library where the driver found it, in case it is not installed there.
    """
    spark = tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark

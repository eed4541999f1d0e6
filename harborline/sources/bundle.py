"""CSV bundles: one file or folder per contract table."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.contract import CONTRACT, REJECT, Table
from harborline.operators.storage import staged
from harborline.operators.validate import FINDING, MESSAGE
from harborline.sources.records import read_records

# Texts that mean a missing value in a CSV file. ``NONE`` does not.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv_text(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """All columns of a CSV file or folder as text, in the order of its header.

    Quotes are doubled inside quoted values. Files whose header differs in names or order are
    refused. ``multiline`` allows line breaks inside values, which keeps a file from
    being split; ``records.read_records`` reads such files in parallel.
    """
    return (
        spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
        .option("mode", "FAILFAST").option("enforceSchema", False).csv(path)
    )


def null_tokens_as_null(column: str) -> Column:
    """Null where the whole text is one of the tokens for a missing value."""
    return F.when(~F.col(f"`{column}`").isin(*NULL_TOKENS), F.col(f"`{column}`")).alias(column)


def with_row_position(df: DataFrame, out: str = "source_row", first: int = 2) -> DataFrame:
    """Number the rows of a file scan in file order, over all files in order of their names.

    ``df`` must read files directly. Rows of one split have consecutive ids, whatever
    task reads them. What goes before a split is looked up by the partition in the high bits of the
    id, from a frame with one row per partition, which is small against the scan and never
    shuffles it. The numbered scan is written to the shared folder, so the files are parsed once.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    split = ["_path", "_start"]
    placed = staged(df.select(
        *columns, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    ), "scan")
    part = F.shiftright("_id", 33)
    sizes = placed.groupBy(*split).agg(F.min("_id").alias("_id"), F.count(F.lit(1)).alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(
        Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    entry = F.struct(F.col("_id").alias("first"), (before - F.col("_id")).alias("shift"))
    starts = sizes.select(part.alias("_part"), entry.alias("entry")).groupBy("_part").agg(
        F.sort_array(F.collect_list("entry")).alias("_starts"))
    own = F.element_at(F.filter("_starts", lambda e: e["first"] <= F.col("_id")), -1)
    return placed.withColumn("_part", part).join(F.broadcast(starts), "_part").select(
        *columns, (F.col("_id") + own["shift"] + first).alias(out)
    )


def read_table(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """One raw table: text columns with missing values as null, and ``source_row``.

    ``multiline`` allows line breaks inside quoted values and columns in another order per file.
    """
    if multiline:
        df = read_records(spark, path).drop("source_line")
    else:
        df = with_row_position(read_csv_text(spark, path))
    return df.select("source_row", *[null_tokens_as_null(c) for c in df.columns if c != "source_row"])


def _found(spark: SparkSession, folder: str, name: str) -> str | None:
    path = f"{folder.rstrip('/')}/{name}.csv"
    try:
        spark.read.text(path)
    except AnalysisException:
        return None
    return path


def read_bundle(spark: SparkSession, folder: str, multiline: bool = False) -> dict[str, DataFrame]:
    """All contract tables found below a folder."""
    paths = {name: _found(spark, folder, name) for name in CONTRACT}
    return {name: read_table(spark, path, multiline) for name, path in paths.items() if path}


def missing_files(spark: SparkSession, found: Collection[str]) -> DataFrame:
    """One finding per contract table without a file."""
    rows = [(name, "missing_file", REJECT, None, 1, MESSAGE["missing_file"].format(column=name), [])
            for name in CONTRACT if name not in found]
    return spark.createDataFrame(rows, FINDING)


def write_csv(df: DataFrame, path: str, compression: str = "none", fast: bool = False) -> None:
    """Write a frame as CSV with a header, blanks at the edges of values kept; a compressed file is read as one split.

    ``fast`` compresses with gzip at its fastest level, which saves most of that time for files larger by a quarter.
    """
    writer = df.write.option("zlib.compress.level", "BEST_SPEED") if fast else df.write
    writer.option("compression", compression).option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(path)


def typed(df: DataFrame, table: Table) -> DataFrame:
    """Contract columns in their declared types; a value that does not parse is an error."""
    return df.select(*[F.col(f.name).cast(f.spark_type).alias(f.name) for f in table.fields])

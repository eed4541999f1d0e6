"""The decomposition report as JSON, and its flat form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.operators.storage import shared_path

# Names of the published header columns.
HEADER = ("kpi", "period_a", "period_b", "value_a", "value_b", "change")

_FACTOR = T.StructType([
    T.StructField("dimension", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("rate_a", T.DoubleType()),
    T.StructField("rate_b", T.DoubleType()),
    T.StructField("orders_a", T.LongType()),
    T.StructField("orders_b", T.LongType()),
    T.StructField("contribution_pp", T.DoubleType()),
    T.StructField("share_of_drop", T.DoubleType()),
    T.StructField("rate_vs_overall", T.DoubleType()),
    T.StructField("share_of_unfulfilled", T.DoubleType()),
    T.StructField("p_value", T.DoubleType()),
    T.StructField("dimension_rank", T.LongType()),
    T.StructField("overall_rank", T.LongType()),
])
REPORT = T.StructType([
    T.StructField("kpi", T.StringType()),
    T.StructField("period_a", T.StringType()),
    T.StructField("period_b", T.StringType()),
    T.StructField("value_a", T.DoubleType()),
    T.StructField("value_b", T.DoubleType()),
    T.StructField("change", T.DoubleType()),
    T.StructField("top_factors", T.ArrayType(_FACTOR)),
])


def read_report(spark, path: str) -> DataFrame:
    """Reports written as JSON lines; fields that are missing become null.

    A report without one of the header fields is refused.
    """
    df = spark.read.schema(REPORT).json(path)
    broken = df.filter(F.greatest(*[F.col(c).isNull() for c in (*HEADER, "top_factors")])).limit(1)
    if not broken.isEmpty():
        raise ValueError(f"report below {path} lacks a header field")
    return df


def flatten_report(report: DataFrame) -> DataFrame:
    """One row per factor with the header repeated."""
    return report.select(*HEADER, F.inline("top_factors"))


def round_trip(report: DataFrame) -> DataFrame:
    """Write a report to the shared folder as JSON and read it back."""
    path = shared_path(report.sparkSession, "report")
    report.write.json(path)
    return read_report(report.sparkSession, path)

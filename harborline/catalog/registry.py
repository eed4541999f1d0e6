"""Registration of queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.session import tune
from harborline.sources.tables import OpsTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six decimals and decimals to doubles, so that engines agree by value."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.DecimalType, T.FloatType)):
            column = (F.round(column.cast("double"), 6) + F.lit(0.0)).alias(field.name)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            column = column.cast("bigint").alias(field.name)
        out.append(column)
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register a function of the operational tables under ``name``."""
    def wrap(fn: Callable[[OpsTables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(fn(OpsTables(tune(spark), folder)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def rounded(body: str, doubles: Sequence[str] = ()) -> str:
    """Wrap a SELECT so that its double columns are rounded to six decimals."""
    if not doubles:
        return body
    parts = ", ".join(f"ROUND(CAST({c} AS DOUBLE), 6) + 0.0 AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({parts}) FROM ({body}) AS result"

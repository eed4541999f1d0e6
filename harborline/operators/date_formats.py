"""The format in which a text column writes its dates.

One aggregate per table counts, for every date column and every known format, the values that parse, and how many a day-first
and a month-first reading take for different days. A column gets the format that most of its values have; ISO wins ties, then
the order of ``FORMATS``. A column in which several formats read the same number of values as different days is
ambiguous: it gets the first of them and is reported. Everything after the aggregate has one row per column and
format.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.contract import CONTRACT, known
from harborline.operators.parsing import DATE_FORMATS, date_sql, strip_sql

#: Formats that read the same texts with day and month exchanged.
EXCHANGED = (("month/day/year", "day/month/year"), ("month-day-year", "day-month-year"), ("month.day.year", "day.month.year"))


def _counted(name: str, frame: DataFrame) -> DataFrame | None:
    """``table``, ``column``, ``format``, ``place``, ``n_values``, ``parsed``, ``differ`` of one table."""
    columns = [f.name for f in CONTRACT[name].fields if f.kind == "date" and f.name in frame.columns]
    if not columns:
        return None
    other = {a: b for pair in EXCHANGED for a, b in (pair, pair[::-1])}
    texts = frame.selectExpr(*[f"{strip_sql(c)} AS {c}" for c in columns])
    days = texts.selectExpr(*[c for c in columns], *[
        f"{date_sql(c, form)} AS d{i}_{j}" for i, c in enumerate(columns) for j, form in enumerate(DATE_FORMATS)])
    places = {form: j for j, form in enumerate(DATE_FORMATS)}
    sums = []
    for i, c in enumerate(columns):
        for form, j in places.items():
            differ = f"count_if(d{i}_{j} <> d{i}_{places[other[form]]})" if form in other else "0"
            sums.append(f"named_struct('table', '{name}', 'column', '{c}', 'format', '{form}', 'place', {j}, "
                        f"'n_values', count_if({c} <> ''), 'parsed', count(d{i}_{j}), 'differ', CAST({differ} AS BIGINT))")
    return days.selectExpr(f"array({', '.join(sums)}) AS found").select(F.inline("found"))


def date_format_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per date column: its ``format``, ``n_values``, how many ``parsed``, and whether it is ``ambiguous``.

    A column without any value that parses counts as ISO.
    """
    known(tables)
    parts = [part for name, frame in tables.items() if (part := _counted(name, frame)) is not None]
    if not parts:
        raise ValueError("no table has a date column")
    counts = reduce(DataFrame.union, parts)
    column = Window.partitionBy("table", "column")
    first = F.row_number().over(column.orderBy(F.desc("parsed"), "place"))
    level = F.max("parsed").over(column)
    # Readings that exchange day and month tie only if both parse everything that either does.
    rivals = F.count_if((F.col("parsed") == F.col("_most")) & (F.col("differ") > 0)).over(column)
    ranked = counts.select("*", first.alias("_rank"), level.alias("_most")).select("*", rivals.alias("_rivals"))
    return ranked.filter("_rank = 1").select(
        "table", "column", "format", "n_values", "parsed",
        ((F.col("differ") > 0) & (F.col("_rivals") > 1)).alias("ambiguous"))


def date_formats(tables: Mapping[str, DataFrame]) -> dict[str, dict[str, str]]:
    """Format by table and column, as ``findings`` and ``clean`` take it."""
    out: dict[str, dict[str, str]] = {name: {} for name in tables}
    for row in date_format_report(tables).collect():  # one row per date column of the contract
        out[row["table"]][row["column"]] = row["format"]
    return out

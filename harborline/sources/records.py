"""CSV records whose quoted values may hold line breaks, read in parallel.

A reader that starts in the middle of a file cannot tell whether a line break ends a record or lies inside
quotes: that depends on the number of quotes before it. So files are read as lines, split as usual, and

* a first pass over each split numbers its lines, keeps the parity of the quotes seen so far, and counts the
  records that begin, once for a split that begins outside quotes and once for one that begins inside;
* the parities and counts of all splits, one row each, are summed up in file order, which tells for every split on which side it
  begins and how many records and lines go before it;
* lines that are a record by themselves stay where they are. Only lines of records with breaks are grouped by the number
  of their record and joined again, also across splits. A record is one row, so it has to fit a task.

Quotes are doubled inside quoted values. Blank lines outside quotes are no records. Line ends are LF or CRLF; breaks
inside quotes stay as they are. Every file has a header; columns are taken by name, so files may order them differently,
and a file that lacks or adds a name is refused, as is one that ends inside quotes. A table
without any record has no header, which is an error.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.operators.storage import staged

HEADERS = 100  # different headers that the files of a table may have
LINES = "_path string, _start bigint, line bigint, value string, inside int, odd int, blank boolean, n0 bigint, n1 bigint"


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of a task with what is known of them inside their split."""
    now, line, parity, begun = None, 0, 0, (0, 0)
    for batch in batches:
        paths, starts = batch.column("_path"), batch.column("_start")
        # A task may read several splits; each is a run of rows.
        turns = [0, batch.num_rows]
        if batch.num_rows > 1:
            same = pc.and_(pc.equal(paths[1:], paths[:-1]), pc.equal(starts[1:], starts[:-1]))
            turns = [0, *(np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
        for low, high in zip(turns, turns[1:]):
            if low == high:
                continue
            part = batch.slice(low, high - low)
            split = (part.column("_path")[0].as_py(), part.column("_start")[0].as_py())
            if split != now:
                now, line, parity, begun = split, 0, 0, (0, 0)
            value = part.column("value")
            odd = pc.count_substring(value, '"').to_numpy(zero_copy_only=False).astype(np.int64) & 1
            inside = (parity + np.cumsum(odd) - odd) & 1
            blank = pc.match_substring_regex(value, "^[\\x00-\\x20]*$").to_numpy(zero_copy_only=False)
            counts = [begun[side] + np.cumsum((inside == side) & ~blank) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays([
                part.column("_path"), part.column("_start"), pa.array(line + np.arange(1, high - low + 1)), value,
                pa.array(inside.astype(np.int32)), pa.array(odd.astype(np.int32)), pa.array(blank),
                pa.array(counts[0]), pa.array(counts[1]),
            ], names=["_path", "_start", "line", "value", "inside", "odd", "blank", "n0", "n1"])
            line += high - low
            parity = int(inside[-1] + odd[-1]) & 1
            begun = (int(counts[0][-1]), int(counts[1][-1]))


def _splits(lines: DataFrame) -> DataFrame:
    """One row per split: the side it begins on, and the records, files and lines that go before it."""
    own = lines.groupBy("_path", "_start").agg(
        F.sum("odd").alias("odd"), F.max("line").alias("lines"), F.max("n0").alias("n0"), F.max("n1").alias("n1"))
    earlier = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    known = own.select("*", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).alias("side"),
                       F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("lines_before"))
    known = known.withColumn("records", F.when(F.col("side") == 0, F.col("n0")).otherwise(F.col("n1")))
    before = Window.orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    known = known.select("*", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("before"))
    whole = Window.partitionBy("_path")
    known = known.select("*", F.min("before").over(whole).alias("file_before"), F.sum("records").over(whole).alias("in_file"),
                         (F.sum("odd").over(whole) % 2).alias("open"))
    first = F.when((F.col("before") == F.col("file_before")) & (F.col("records") > 0), 1).otherwise(0)
    # A file's header is counted at the split in which the file's first record begins.
    upto = Window.orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    headers = F.sum(first).over(upto)
    return known.select("_path", "_start", "side", "lines_before", "before", "file_before", "open",
                        headers.alias("headers"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of a file or folder: ``text``, its ``file``, its number in the file, and its places.

    ``number`` is 1 for a header, ``row`` counts the data rows of all files, and ``line`` is the line of the file on which the record begins.
    """
    scan = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"), "value")
    lines = staged(scan.mapInArrow(_scanned, LINES), "lines")
    splits = staged(_splits(lines), "splits")
    for unclosed in splits.filter("open = 1").select("_path").limit(1).collect():
        raise ValueError(f"{unclosed['_path']} ends inside quotes")
    inside = F.col("inside").bitwiseXOR(F.col("side").cast("int"))
    begun = F.when(F.col("side") == 0, F.col("n0")).otherwise(F.col("n1"))
    placed = lines.join(F.broadcast(splits), ["_path", "_start"]).select(
        F.col("_path").alias("file"), (F.col("before") + begun).alias("record"), "file_before", "headers",
        (F.col("lines_before") + F.col("line")).alias("line"), "value", inside.alias("inside"), "odd", "blank",
    ).filter("inside = 1 OR NOT blank")
    alone = placed.filter("inside = 0 AND odd = 0").select("record", "file", "file_before", "headers", "line", "value")
    # The first line of a record knows the headers before it; its other lines may lie in later splits.
    joined = placed.filter("inside = 1 OR odd = 1").groupBy("record").agg(
        F.min("file").alias("file"), F.min("file_before").alias("file_before"),
        F.min_by("headers", "line").alias("headers"), F.min("line").alias("line"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", "value"))), lambda x: x["value"]), "\n").alias("value"))
    return alone.unionByName(joined).select(
        F.regexp_replace("value", "\r$", "").alias("text"), "file", (F.col("record") - F.col("file_before")).alias("number"),
        (F.col("record") - F.col("headers")).alias("row"), "line")


def header_names(text: str) -> list[str]:
    """Column names of a header; a name that is missing becomes ``_c`` and its place."""
    names = [n or f"_c{i}" for i, n in enumerate(next(csv.reader(io.StringIO(text.removeprefix("﻿"), newline=""))))]
    if len(set(names)) < len(names):
        raise ValueError(f"header repeats a name: {text}")
    return names


def _fields(names: list[str], order: list[str]) -> Column:
    """The values of a record under the given header, as a struct in the given order."""
    schema = ", ".join(f"c{i} STRING" for i in range(len(names)))
    parsed = F.from_csv("text", schema, {"escape": '"', "mode": "FAILFAST", "multiLine": "true"})
    return F.struct(*[parsed[f"c{names.index(n)}"].alias(n) for n in order])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All columns of a CSV file or folder as text, ``source_row`` (the first data row is 2) and ``source_line``.

    ``source_row`` counts records over all files in order of their names; ``source_line`` is the line of the record's own file.
    """
    found = records(spark, path)
    headers = found.filter("number = 1").groupBy("text").agg(F.min("file").alias("file"))
    texts = [r["text"] for r in headers.orderBy("file").limit(HEADERS + 1).collect()]
    if not texts:
        raise ValueError(f"no header below {path}")
    if len(texts) > HEADERS:
        raise ValueError(f"files below {path} have more than {HEADERS} different headers")
    names = {t: header_names(t) for t in texts}
    order = names[texts[0]]
    for text, own in names.items():
        if sorted(own) != sorted(order):
            raise ValueError(f"files below {path} have headers with other names: {texts[0]} and {text}")
    rows, values = found.filter("number > 1"), _fields(order, order)
    if len(texts) > 1:
        own = found.filter("number = 1").select("file", F.col("text").alias("header"))
        rows = rows.join(staged(own, "headers"), "file")
        for text in texts[1:]:
            values = F.when(F.col("header") == text, _fields(names[text], order)).otherwise(values)
    parsed = rows.select(values.alias("_v"), (F.col("row") + 1).alias("source_row"), F.col("line").alias("source_line"))
    return parsed.select(*[F.col("_v")[n].alias(n) for n in order], "source_row", "source_line")

"""A numbered log of commits in a folder that all executors share.

A commit is a small JSON file that is written aside and renamed to its number, which fails if the number is taken. So of
two writers that start from the same commit one wins and the other gets a ``Conflict``, and a reader never sees half a
commit. This needs a store whose rename refuses to overwrite, as HDFS does. Data that a lost writer
left behind is named by no commit; give the folder an expiry rule or remove what no commit names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import SparkSession

WIDTH = 12  # digits of a number, so that names sort like numbers


class Conflict(RuntimeError):
    """Another writer has taken the number of a commit."""


def _log(folder: str) -> str:
    return f"{folder.rstrip('/')}/_commits"


def _store(spark: SparkSession, path: str):
    """The path as the store's library names it, and the store."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named, named.getFileSystem(spark._jsc.hadoopConfiguration())


def last_commit(spark: SparkSession, folder: str) -> int:
    """Number of the last commit, 0 without any."""
    path, store = _store(spark, _log(folder))
    if not store.exists(path):
        return 0
    names = [s.getPath().getName() for s in store.listStatus(path)]
    return max((int(n[:WIDTH]) for n in names if len(n) == WIDTH + 5 and n.endswith(".json")), default=0)


def read_commit(spark: SparkSession, folder: str, number: int) -> dict:
    """The content of a commit."""
    path, store = _store(spark, f"{_log(folder)}/{number:0{WIDTH}d}.json")
    if number < 1 or not store.exists(path):
        raise ValueError(f"{folder} has no commit {number}")
    stream = store.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, folder: str, number: int, content: dict) -> None:
    """Make ``content`` commit ``number``, or raise ``Conflict`` if that number is taken."""
    target, store = _store(spark, f"{_log(folder)}/{number:0{WIDTH}d}.json")
    aside, _ = _store(spark, f"{_log(folder)}/.{uuid.uuid4().hex}")
    out = store.create(aside, False)
    try:
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    finally:
        out.close()
    jvm, rename = spark._jvm, getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration())
    kept = spark.sparkContext._gateway.new_array(rename, 1)
    kept[0] = rename.valueOf("NONE")
    try:
        context.rename(store.makeQualified(aside), store.makeQualified(target), kept)
    except Exception as error:  # the gateway's own error, or Spark's wrapper of it
        store.delete(aside, False)
        if "AlreadyExists" in str(error) or isinstance(error, PySparkException) and store.exists(target):
            raise Conflict(f"commit {number} of {folder} was made by another writer") from error
        raise

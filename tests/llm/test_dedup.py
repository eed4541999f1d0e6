from collections import Counter

import pytest
from pyspark.sql import functions as F

from harborline.llm import dedup

ROWS = [(1, "a"), (2, "a"), (3, "b"), (None, "a"), (5, None), (6, ""), (7, "b "), (3, "b"), (8, "B"), (9, "x" * 300_000)]


def result(df):
    return {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()}


def test_groups(docs):
    got = dedup.exact_groups(docs(ROWS))
    rows = sorted((str(r.doc_id), r.keep_id, r.group_size, r.kept) for r in got.collect())
    assert rows == sorted([
        ("1", 2, 3, False), ("2", 2, 3, True), ("None", 2, 3, False), ("3", 3, 2, True), ("3", 3, 2, False),
        ("5", 6, 2, False), ("6", 6, 2, True), ("7", 7, 1, True), ("8", 8, 1, True), ("9", 9, 1, True)])
    assert len(got.filter("doc_id = 5").first().text_sha256) == 64


@pytest.mark.parametrize("length", [1, 2])
def test_collisions_are_told_apart(docs, monkeypatch, length):
    """With a hash that collides on purpose, the bytes decide."""
    expected = result(dedup.exact_groups(docs(ROWS)))
    monkeypatch.setattr(dedup, "content_hash", lambda text: F.unhex(F.substring(F.md5(text), 1, 2 * (length - 1))))
    assert result(dedup.exact_groups(docs(ROWS))) == expected


def test_drop_keeps_columns_and_one_of_each(docs):
    df = docs(ROWS).withColumns({"hash": F.lit(1), "_row": F.lit(2), "number": F.lit(3), "best": F.lit(4)})
    out = dedup.drop_exact(df)
    assert out.columns == df.columns
    assert Counter(r.text or "" for r in out.collect()) == Counter({"a": 1, "b": 1, "": 1, "b ": 1, "B": 1, "x" * 300_000: 1})
    assert out.filter("text = 'a'").first().doc_id == 2


def test_all_ids_null(docs):
    rows = dedup.exact_groups(docs([(None, "a"), (None, "a"), (None, "b")])).collect()
    assert sorted((r.group_size, r.kept) for r in rows) == [(1, True), (2, False), (2, True)]


def test_empty(docs):
    df = docs([(1, "a")]).limit(0)
    assert dedup.exact_groups(df).count() == 0
    assert dedup.drop_exact(df).columns == df.columns

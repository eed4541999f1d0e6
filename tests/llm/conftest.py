import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harborline.llm.frames import tuned  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """Documents from (id, text) or (id, text, source) rows, in several partitions."""
    def build(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return tuned(spark).createDataFrame(full, DOCS).repartition(parts)

    return build


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(spark, folder):
    """Id, text and source of the smallest documents table."""
    rows = tuned(spark).read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()
    return [tuple(r) for r in rows]

from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from tables import write_tables  # noqa: E402


@pytest.fixture(scope="session")
def folder(spark):
    return write_tables(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/small")


@pytest.fixture(scope="session")
def empty_folder(spark):
    return write_tables(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/empty", empty=True)


@pytest.fixture(scope="session")
def docs(spark, folder):
    """(doc_id, text) of every row."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]

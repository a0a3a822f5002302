from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


@pytest.fixture
def documents(spark):
    """A table of (doc_id, text) with columns whose names clash with results and inner names."""

    def build(rows):
        clash = "fingerprint string, score double, id long, row string, kept string, n_bytes long, part int, length int"
        data = [(d, t, "x", 0.5, 9, "r", "k", 1, 2, 3) for d, t in rows]
        return spark.createDataFrame(data, f"doc_id long, text string, {clash}")

    return build

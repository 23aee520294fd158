from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent.parent), str(Path(__file__).parent)]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture(scope="session")
def documents(spark):
    """Build documents from (doc_id, text) or longer rows."""

    def build(rows):
        rows = [(*r, *[None] * (5 - len(r))) for r in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return build

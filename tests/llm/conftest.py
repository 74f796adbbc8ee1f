import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_cases import TEXTS  # noqa: E402


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows that every operator must take, with columns whose names clash with its own."""
    rows = [(i, t, "x", 3, 1.5, b"k") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, block string, piece int, score double, digest binary")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)

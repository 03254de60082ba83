from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_support import ODD, frame  # noqa: E402


@pytest.fixture
def odd(spark):
    """Documents with NULLs, repeated rows, empty and long texts, and clashing columns."""
    return frame(spark, ODD)


@pytest.fixture
def none(spark):
    """No documents."""
    return frame(spark, ODD).limit(0)


@pytest.fixture
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

from llm_tables import SCHEMAS

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture
def write_tables(spark, tmp_path: Path):
    """Write the given tables, and empty ones for the rest; returns the folder."""

    def write(**tables):
        for name, schema in SCHEMAS.items():
            df = tables.get(name)
            if df is None:
                df = spark.createDataFrame([], schema)
            elif isinstance(df, list):
                df = spark.createDataFrame(df, schema)
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write

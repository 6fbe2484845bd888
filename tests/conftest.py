from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from deskloom import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.log.level", "OFF")
        .getOrCreate()
    )
    yield configure(session)
    session.stop()


def rows_of(df, *columns):
    """Rows as sorted tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)

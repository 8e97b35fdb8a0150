from __future__ import annotations

import math
import os
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import DataFrame, SparkSession

os.environ.setdefault("TZ", "UTC")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for f in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _told(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return round(float(v), 9)
    return str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    """Rows with their columns by name, in an order of their own."""
    at = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(_told(r[k]) for k in at) for r in rows), key=repr)


def same(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, found.fetchall())

"""One session for all tests, and tables to compare."""

from __future__ import annotations

import math
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "6g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="session")
def sf():
    return SF


def plain(v):
    """Values that compare alike from either engine."""
    if hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.fixture(scope="session")
def same_rows(spark, duck, sf):
    """Asserts that a query and its SQL give the same columns and rows."""

    def check(query, sql):
        df = query(spark, sf)
        order = sorted(df.columns)
        found = duck.execute(sql)
        names = [d[0] for d in found.description]
        assert order == sorted(names)
        ours = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
        theirs = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in found.fetchall()), key=repr)
        assert ours == theirs

    return check

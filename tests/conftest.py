from __future__ import annotations

import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def rows_of(frame):
    """Rows in one form and order, columns by name."""
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object)
    return sorted(map(repr, plain.where(plain.notna(), None).values.tolist()))


@pytest.fixture(scope="session")
def same_as_duck(spark, duck, sf_dir):
    def check(query, sql):
        ours, theirs = query(spark, sf_dir).toPandas(), duck.execute(sql).df()
        assert sorted(ours.columns) == sorted(theirs.columns)
        assert rows_of(ours) == rows_of(theirs)

    return check

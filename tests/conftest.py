import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    import __spark_entry__  # noqa: F401

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.fixture(scope="session")
def same(spark, duck, data):
    """Asserts that a query and its SQL give the same rows; returns their number."""

    def tidy(columns, rows):
        order = sorted(range(len(columns)), key=lambda i: columns[i])
        return [columns[i] for i in order], sorted(repr(tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order)) for r in rows)

    def check(query, sql):
        df = query(spark, data)
        got = tidy(df.columns, [tuple(r) for r in df.collect()])
        cursor = duck.execute(sql)
        assert got == tidy([x[0] for x in cursor.description], cursor.fetchall())
        return len(got[1])

    return check

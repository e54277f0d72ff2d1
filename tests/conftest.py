"""One local session for all tests, and a comparison of registered queries with their DuckDB counterparts."""

import os
import sys
import tempfile

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    tmp = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    conf = {
        "spark.master": "local[8]", "spark.driver.memory": "6g", "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false",
        "spark.checkpoint.dir": f"{tmp}/shared", "spark.local.dir": f"{tmp}/local", "spark.sql.warehouse.dir": f"{tmp}/warehouse", "spark.ui.showConsoleProgress": "false",
    }
    s = SparkSession.builder.config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(rows: list, columns: list) -> list:
    """Rows as sorted tuples in the order of column names; floats to 9 digits."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda x: f"{x:.9g}" if isinstance(x, float) else str(x)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="session")
def agree(spark, duck):
    def check(name: str, query, sql: str) -> int:
        df = query(spark, DATA)
        got = plain([tuple(r) for r in df.collect()], df.columns)
        rel = duck.sql(sql)
        want = plain(rel.fetchall(), rel.columns)
        assert sorted(df.columns) == sorted(rel.columns), name
        assert len(got) == len(want), (name, len(got), len(want))
        odd = [(a, b) for a, b in zip(got, want, strict=True) if a != b]
        assert not odd, (name, len(odd), odd[:3])
        return len(got)

    return check

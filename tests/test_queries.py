"""Every registered query against its SQL on the small tables."""

from pathlib import Path

import duckdb
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry_points
from check import TABLES, compare
from workload.oracle import ORACLE
from workload.queries import QUERIES, write_spread

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{FOLDER}/{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


needs_data = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@needs_data
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, FOLDER).startswith("ok")


@needs_data
def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(ORACLE) <= set(entry_points.oracle_sql())


def test_large_tables_are_spread_over_more_than_a_few_tasks(spark, tmp_path):
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "64k")
    try:
        for n, least in ((400_000, 8), (7, 3), (2, 2), (0, 1)):
            path = str(tmp_path / str(n))
            write_spread(spark.range(0, n, 1, 16), path)
            assert spark.read.parquet(path).count() == n
            sizes = [pq.ParquetFile(p).metadata.num_rows for p in Path(path).glob("part-*")]
            assert len(sizes) >= least and (not n or min(sizes))
    finally:
        spark.conf.set(setting, before)

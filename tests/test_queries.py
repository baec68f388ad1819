"""Every registered query against its SQL counterpart, on the whole smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as driver
from workload import queries

SF_DIR = driver.ENTRY_DIR
TABLES = ("part", "documents", "embeddings", "benchmark", "conversations")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, database, name):
    result = driver.queries()[name](spark, SF_DIR).toArrow()
    columns = sorted(result.column_names)
    assert result.num_rows > 0
    if name not in driver.oracle_sql():
        return
    expected = database.sql(driver.oracle_sql()[name]).to_arrow_table()
    assert sorted(expected.column_names) == columns
    rows = [ordered(zip(*(t[c].to_pylist() for c in columns))) for t in (result, expected)]
    assert rows[0] == rows[1]


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_damaged_corpus_is_written_by_several_tasks(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        folder = queries._damaged_corpus(spark, SF_DIR)
    finally:
        spark.conf.set(key, before)
    files = spark.sparkContext.wholeTextFiles(f"{folder}/whole.csv/*.txt").values().map(str.splitlines).collect()
    assert len(files) > 1 and all(lines[0] == "id,name,cluster" and len(lines) > 1 for lines in files)
    assert sum(len(lines) - 1 for lines in files) == spark.read.parquet(f"{SF_DIR}/part.parquet").count()

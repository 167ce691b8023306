"""Every registered query that SQL can express, against DuckDB, as whole sets."""

import duckdb
import pytest

import __spark_entry__ as entry_point

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_matches_oracle(spark, duck, sf_dir, name):
    ours = entry_point.queries()[name](spark, sf_dir)
    theirs = duck.execute(entry_point.oracle_sql()[name])
    names = [column[0] for column in theirs.description]
    assert sorted(names) == sorted(ours.columns)
    expected = sorted((tuple(row) for row in theirs.fetchall()), key=repr)
    found = sorted((tuple(row) for row in ours.select(*[f"`{n}`" for n in names]).collect()), key=repr)
    assert len(expected) > 0
    assert found == expected


@pytest.mark.parametrize("name", sorted(set(entry_point.queries()) - set(entry_point.oracle_sql())))
def test_runs_without_oracle(spark, sf_dir, name):
    result = entry_point.queries()[name](spark, sf_dir)
    assert len(result.collect()) > 0


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["asin", "meanRating", "countRating"]
    assert result.count() == 200


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())

"""The registered text queries against their DuckDB counterparts, on whole tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest
from __spark_entry__ import queries

from daytally.llm.oracles import oracles


@pytest.fixture(scope="module")
def duck(medium):
    connection = duckdb.connect()
    for table in Path(medium).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def counted(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(r[i] for i in order) for r in records)


@pytest.mark.parametrize("name", list(oracles()))
def test_matches_sql(spark, duck, medium, name):
    ours, theirs = queries()[name](spark, medium), duck.sql(oracles()[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    got = counted(ours.columns, ours.collect())
    assert got and got == counted(theirs.columns, theirs.fetchall())


def test_all_operators_and_the_pipeline_are_registered():
    names = {name.split("_")[0] for name in queries()}
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} <= names

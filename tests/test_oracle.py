"""Every registered query against its DuckDB counterpart, and against the recorded row counts."""

from collections import Counter
from datetime import date, datetime
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import LOG_QUERIES as QUERIES
from __spark_entry__ import entry, oracle_sql, queries
from duckdb_queries import ORACLES


def plain(value):
    if isinstance(value, datetime) and value.time() == datetime.min.time():
        return value.date()
    return value


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def duck(medium):
    connection = duckdb.connect()
    for table in Path(medium).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, duck, medium, name):
    ours = QUERIES[name](spark, medium)
    theirs = duck.sql(oracle_sql()[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    got, expected = rows(ours.columns, ours.collect()), rows(theirs.columns, theirs.fetchall())
    assert expected
    assert got == expected


# Target day 2024-01-30 or the whole table, at scale factors 0.01 and 0.001.
RECORDED = {
    "normalize_grade_code": (10_000, 1_000, None),
    "kst_archive": (315, 27, "kr_date = '2024-01-15'"),
    "active_user_events": (7_340, None, None),
    "active_class_events": (1_397, None, None),
    "unique_user_1d": (235, 27, "date = '2024-01-30'"),
    "unique_user_7d": (1_637, 150, "date = '2024-01-30'"),
    "unique_user_30d": (6_556, 674, "date = '2024-01-30'"),
    "unique_class_1d": (49, 5, "date = '2024-01-30'"),
    "unique_class_7d": (332, 38, "date = '2024-01-30'"),
    "unique_class_30d": (1_313, 140, "date = '2024-01-30'"),
    "unique_user_last_day": (235 + 1_637 + 6_556, 27 + 150 + 674, None),
    "daily_user_rollup": (7_329, None, None),
    "rolling_user_counts": (24_764, None, "date >= '2024-01-28'"),
    "unique_user_nodev": (1_602, None, "date = '2024-01-30'"),
    "user_signups": (1_554, 156, None),
    "user_deletions": (1_356, 123, None),
    "class_creations": (690, 76, None),
    "class_deletions": (855, 84, None),
    "lifecycle_all": (1_554 + 1_356 + 690 + 855, 156 + 123 + 76 + 84, None),
    "role_carry_forward": (1_554, 156, None),
    "distinct_active_ids": (2_798, None, None),
    "cohort_churned_ids": (160, 14, None),
}


@pytest.mark.parametrize("name", list(RECORDED))
def test_recorded_counts(spark, medium, small, name):
    at_medium, at_small, condition = RECORDED[name]
    for folder, expected in ((medium, at_medium), (small, at_small)):
        if expected is not None:
            df = QUERIES[name](spark, folder)
            assert (df.where(condition) if condition else df).count() == expected


def test_recorded_retention(spark, medium, small):
    def result(name, folder):
        return [tuple(r) for r in QUERIES[name](spark, folder).orderBy("retained").collect()]

    assert result("cohort_same_window", medium) == [(1158, 1158, 100.0)]
    assert result("cohort_same_window", small) == [(121, 121, 100.0)]
    assert result("cohort_prior_window", medium) == [(674, 514, 76.261)]
    assert result("cohort_prior_window", small) == [(69, 55, 79.71)]
    assert result("cohort_curve", medium) == [(1, 458, 281, 61.354), (2, 458, 294, 64.192)]


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "unique_cnt" in df.columns


def test_dates_are_dates(spark, small):
    assert isinstance(QUERIES["kst_archive"](spark, small).first()["kr_date"], date)

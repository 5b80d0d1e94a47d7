"""What the physical plans must look like on a stored log, whatever the size of the data."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import LOG_QUERIES
from daytally.functions.periods import Period, run_period
from daytally.operators import activity, retention
from daytally.operators.archive import local_archive
from daytally.operators.lifecycle import lifecycle, lifecycle_events
from daytally.operators.publish import as_unique_stats
from daytally.sources import tables
from daytally.sources.events_table import log_from_events
from daytally.sources.logs import read_logs

MONTH = run_period("20240130", 30)
WEEK = run_period("20240130", 7)


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "table")
    log_from_events(spark, small).write.partitionBy("log_date").parquet(path)
    return path


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def exchanges(text):
    return re.findall(r"^Arguments: (hashpartitioning|rangepartitioning|SinglePartition)", text, re.M)


def scans(text):
    return re.findall(r"^\(\d+\) Scan parquet", text, re.M)


def read_columns(text):
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*)>", text).group(1)))


def operators_on_table(spark, stored):
    log = read_logs(spark, stored, MONTH, fmt="parquet")
    half, other = Period(MONTH.first, MONTH.days()[14]), Period(MONTH.days()[15], MONTH.last)
    return {
        "rollup": activity.daily_rollup(log, ["user"]),
        "rollup_all": activity.daily_rollup(log),
        "rolling": activity.rolling_counts(activity.daily_rollup(log, ["user"]), MONTH),
        "one_day": activity.unique_counts(log, MONTH.last),
        "events": lifecycle_events(log),
        "archive": local_archive(log, MONTH),
        "retention": retention.cohort_retention(log, half, other),
        "curve": retention.cohort_curve(log, half, [half, other]),
        "churned": retention.churned_ids(log, half, other),
        "by_day": retention.cohort_by_day(log, WEEK, (14, 8), (7, 1)),
    }


def test_one_scan_and_few_shuffles(spark, stored):
    plans = {name: plan(df) for name, df in operators_on_table(spark, stored).items()}
    assert {name: len(scans(text)) for name, text in plans.items()} == dict.fromkeys(plans, 1)
    assert {name: exchanges(text) for name, text in plans.items()} == {
        "rollup": ["hashpartitioning"],
        "rollup_all": ["hashpartitioning"],
        "rolling": ["hashpartitioning"] * 2,
        "one_day": ["hashpartitioning"],
        "events": [],
        "archive": [],
        # The single partition receives one row of totals per task.
        "retention": ["hashpartitioning", "SinglePartition"],
        "curve": ["hashpartitioning", "SinglePartition"],
        "churned": ["hashpartitioning"],
        "by_day": ["hashpartitioning"] * 2,
    }


def test_filters_and_columns_reach_the_scan(spark, stored):
    plans = {name: plan(df) for name, df in operators_on_table(spark, stored).items()}
    events = plans["events"]
    pushed = re.search(r"PushedFilters: \[(.*)\]", events).group(1)
    assert "EqualTo(code,200)" in pushed and "In(method, [DELETE,POST])" in pushed and "IsNotNull(api)" in pushed
    assert "LessThanOrEqual(ftime,2024-01-30T15)" in re.search(r"PushedFilters: \[(.*)\]", plans["archive"]).group(1)
    for name in ("retention", "curve", "churned", "by_day"):
        pushed = re.search(r"PushedFilters: \[(.*)\]", plans[name]).group(1)
        assert "IsNotNull(id)" in pushed and "IsNotNull(api)" in pushed and "Not(In(api, [_null,page_move]))" in pushed
    assert read_columns(plans["by_day"]) == {"api", "method", "code", "id"}
    assert read_columns(plans["rollup"]) == {
        "api", "code", "id", "role", "device", "tag", "country", "language", "grade",
    }
    for text in plans.values():
        assert "log_date" in re.search(r"PartitionFilters: \[(.*)\]", text).group(1)


def test_carried_roles_need_no_join_and_no_single_task(spark, stored):
    text = plan(lifecycle(read_logs(spark, stored, MONTH, fmt="parquet")))
    assert "Join" not in text and "SinglePartition" not in text
    assert set(exchanges(text)) == {"hashpartitioning"}


def test_one_day_window_is_the_rollup(spark, stored):
    log = read_logs(spark, stored, MONTH, fmt="parquet")
    text = plan(activity.rolling_counts(activity.daily_rollup(log, ["user"]), MONTH, [1]))
    assert exchanges(text) == ["hashpartitioning"] and "Window" not in text


def test_stamps_are_made_once_per_day(spark, stored):
    log = read_logs(spark, stored, MONTH, fmt="parquet")
    counts = activity.rolling_counts(activity.daily_rollup(log, ["user"]), MONTH)
    assert "date_format" not in plan(as_unique_stats(counts, MONTH)) and "date_format" in plan(as_unique_stats(counts))
    assert as_unique_stats(counts, MONTH).exceptAll(as_unique_stats(counts)).isEmpty()


def test_replacing_partitions_reads_no_rows(spark, tmp_path, monkeypatch):
    """Which partitions exist is told by the listing, before and after a write."""
    seen = []
    plain = tables._files

    def spy(spark, path, *rest):
        reads = spark.read.schema
        monkeypatch.setattr(type(spark.read), "schema", lambda self, s: seen.append(s) or reads(s))
        try:
            return plain(spark, path, *rest)
        finally:
            monkeypatch.undo()
            monkeypatch.setattr(tables, "_files", spy)

    monkeypatch.setattr(tables, "_files", spy)
    df = spark.range(100).selectExpr("id", "id % 3 as part")
    for _ in range(2):
        tables.write_partitioned(df, str(tmp_path / "t"), ["part"], F.lit(True))
    assert seen == []
    listed = tables._files(spark, str(tmp_path / "t"), df.schema, ["part"], F.col("part") < 2)
    assert set(listed) == {(0,), (1,)} and all(f.endswith(".parquet") for f in listed.values())


def test_look_back_reads_only_its_days(spark, stored):
    log = read_logs(spark, stored, MONTH, fmt="parquet")
    text = plan(activity.unique_counts(log, "20240130", windows=[1, 3]))
    assert "2024-01-28" in re.search(r"PartitionFilters: \[(.*)\]", text).group(1)


@pytest.mark.parametrize("name", list(LOG_QUERIES))
def test_no_python_and_no_pair_joins(spark, small, name):
    text = plan(LOG_QUERIES[name](spark, small))
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "rangepartitioning"):
        assert unwanted not in text

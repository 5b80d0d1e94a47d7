"""Operators on frames small enough to work out by hand or by brute force, with hot keys included."""

import random
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from daytally.functions.periods import Period, run_period
from daytally.operators import activity, retention
from daytally.operators.carry import carry_forward, sorted_runs
from daytally.operators.lifecycle import KINDS, lifecycle
from daytally.operators.publish import as_accum_stats, as_cohort, as_unique_stats
from daytally.schema import ACCUM_SCHEMA, COHORT_SCHEMA, UNIQUE_SCHEMA, Endpoints
from daytally.sources.events_table import log_from_events
from test_rules import log

DAY = date(2024, 1, 1)
SIGNUP = {"api": Endpoints().signup_urls[0], "method": "POST", "code": "200"}
VISIT = {"api": "https://www.example.com/api/feed", "method": "GET", "code": "200"}


def day(n):
    return DAY + timedelta(days=n)


def carried(df, *order):
    return [r.role for r in df.orderBy(*order).collect()]


ROLES = "day int, at string, n long, role string"


def carry(df):
    return carry_forward(df, "role", partition=["day"], order=["at", "n"], initial="_null")


def test_carry_forward_by_hand(spark):
    roles = ["", None, "", "a", "", None, ""]
    df = spark.createDataFrame([(1, "t", i, r) for i, r in enumerate(roles)], ROLES)
    assert carried(carry(df), "n") == ["_null", None, None, "a", "a", None, None]


def test_carry_forward_starts_anew_per_partition(spark):
    df = spark.createDataFrame([(1, "t", 0, "a"), (2, "t", 1, ""), (2, "t", 2, "b"), (2, "t", 3, "")], ROLES)
    assert carried(carry(df), "n") == ["a", "_null", "b", "b"]
    assert carry(df).columns == df.columns


def test_carry_forward_of_nothing(spark):
    assert carry(spark.createDataFrame([], ROLES)).count() == 0


@pytest.mark.parametrize("known_share", [0.5, 0.0005])
def test_carry_forward_across_many_runs(spark, known_share):
    """One day holds most rows and one stamp a third of them; runs without any known role lie in between."""
    rng = random.Random(7)
    rows = []
    for n in range(30_000):
        at = "hot" if n % 3 == 0 else f"{rng.randrange(10_000):05d}"
        role = rng.choice(["a", "b", None]) if rng.random() < known_share else ""
        rows.append((0 if rng.random() < 0.8 else rng.randrange(5), at, n, role))
    rng.shuffle(rows)

    expected, last = {}, defaultdict(lambda: "_null")
    for d, _, n, role in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if role != "":
            last[d] = role
        expected[n] = last[d]

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, ROLES).repartition(16)
        assert df.orderBy("day", "at", "n").rdd.getNumPartitions() > 4
        result = carry(df).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert {r.n: r.role for r in result} == expected


def test_equal_rows_fall_into_several_runs(spark):
    """Copies of one line share even their number; a third of the rows are such copies."""
    rows = [(1, "t", 5, "")] * 10_000 + [(1, f"{n:05d}", n, "a") for n in range(20_000)]
    df = spark.createDataFrame(rows, ROLES).repartition(16)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in sorted_runs(df, ["day", "at", "n"]).groupBy("_run").count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * len(rows) / 8
        assert {r.role for r in carry(df).where("at = 't'").collect()} == {"a"}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_carry_is_separate_for_each_kind(spark):
    create, delete = SIGNUP, {"api": Endpoints().users + "/1", "method": "DELETE", "code": "200"}
    df = log(
        spark,
        {**create, "log_date": DAY, "ftime": "1", "role": "teacher"},
        {**delete, "log_date": DAY, "ftime": "2", "role": ""},
        {**create, "log_date": DAY, "ftime": "3", "role": ""},
        {**VISIT, "log_date": DAY, "ftime": "4", "role": "parent"},
        {**create, "log_date": DAY, "ftime": "5", "role": ""},
    )
    rows = {(r.kind, r.event_id): r.role for r in lifecycle(df).collect()}
    assert rows == {("user", 0): "teacher", ("user-del", 1): "_null", ("user", 2): "teacher", ("user", 4): "teacher"}


def test_lifecycle_keeps_missing_language_and_device_text(spark):
    df = log(spark, {**SIGNUP, "log_date": DAY, "device": None, "language": None, "grade": "n/a"})
    row = lifecycle(df, ["user"]).first()
    assert (row.device, row.lang, row.grade, row.country) == ("null", None, None, None)


def random_log(spark, seed, days=12, size=1500):
    """A third of all rows belong to one id."""
    rng = random.Random(seed)
    rows = []
    for n in range(size):
        kind = SIGNUP if rng.random() < 0.1 else VISIT
        user = "hot" if n % 3 == 0 else f"u{rng.randrange(60)}"
        rows.append({**kind, "log_date": day(rng.randrange(days)), "id": user, "device": rng.choice(["ios", None])})
    return rows, log(spark, *rows)


@pytest.mark.parametrize("windows", [(1,), (1, 3, 5)])
def test_rolling_counts_by_brute_force(spark, windows):
    rows, df = random_log(spark, 1)
    targets = Period(day(2), day(13))
    expected = Counter()
    for row in rows:
        for target in targets.days():
            for window in windows:
                if 0 <= (target - row["log_date"]).days < window:
                    expected[target, window, row["id"], row["device"] or "_null"] += 1
    result = activity.rolling_counts(activity.daily_rollup(df, ["user"]), targets, windows).collect()
    assert {(r.date, r.window_days, r.id, r.device): r.unique_cnt for r in result} == expected
    assert len(result) == len(expected)


def test_one_day_equals_its_share_of_the_rolling_counts(spark, small):
    df = log_from_events(spark, small)
    rolling = activity.rolling_counts(activity.daily_rollup(df), run_period("20240130", 30))
    for target in (date(2024, 1, 1), date(2024, 1, 17), date(2024, 1, 30)):
        direct = activity.unique_counts(df, target)
        share = rolling.where(F.col("date") == F.lit(target))
        assert Counter(direct.collect()) == Counter(share.collect())


def test_one_scan_for_all_subjects_equals_one_each(spark, small):
    df = log_from_events(spark, small)
    each = [Counter(activity.daily_rollup(df, [subject]).collect()) for subject in activity.SUBJECTS]
    assert Counter(activity.daily_rollup(df).collect()) == each[0] + each[1]


def test_shortest_window_is_the_rollup_and_counts_grow_with_length(spark, small):
    daily = activity.daily_rollup(log_from_events(spark, small), ["user"])
    rolling = activity.rolling_counts(daily, run_period("20240130", 30))
    shortest = rolling.where("window_days = 1").drop("window_days").withColumnRenamed("date", "log_date")
    assert Counter(shortest.collect()) == Counter(daily.collect())
    totals = rolling.groupBy("date").pivot("window_days", [1, 7, 30]).sum("unique_cnt")
    assert totals.where("`1` > `7` or `7` > `30`").count() == 0


def test_equal_grades_in_different_writing_are_one_row(spark):
    visit = {**VISIT, "log_date": DAY, "id": "a"}
    rows = activity.daily_rollup(log(spark, {**visit, "grade": "3"}, {**visit, "grade": "03"})).collect()
    assert [(r.grade, r.unique_cnt) for r in rows] == [(3, 2)]


def test_collapsing_devices_keeps_the_total(spark, small):
    daily = activity.daily_rollup(log_from_events(spark, small), ["user"])
    collapsed = activity.without_device(daily)
    assert collapsed.columns == daily.columns
    assert collapsed.agg(F.sum("unique_cnt")).first() == daily.agg(F.sum("unique_cnt")).first()
    assert [tuple(r) for r in collapsed.select("device", "grade").distinct().collect()] == [("_all", 0)]


def brute_retention(rows, signup, active):
    def ids(period, wanted):
        return {
            r["id"] for r in rows if r["id"] is not None and period.first <= r["log_date"] <= period.last and wanted(r)
        }

    signed, seen = ids(signup, lambda r: r["method"] == "POST"), ids(active, lambda r: True)
    return len(signed), len(signed & seen)


def test_retention_by_day_by_brute_force(spark):
    rows, df = random_log(spark, 2, days=20, size=400)
    targets = Period(day(3), day(30))
    for signup_days, activity_days in (((8, 5), (4, 1)), ((5, 1), (5, 1)), ((2, 1), (9, 4))):
        result = retention.cohort_by_day(df, targets, signup_days, activity_days).collect()
        assert sorted(r.date for r in result) == targets.days()
        for r in result:
            windows = [
                Period(r.date - timedelta(days=far), r.date - timedelta(days=near))
                for far, near in (signup_days, activity_days)
            ]
            signup, retained = brute_retention(rows, *windows)
            assert (r.signup, r.retained) == (signup, retained)
            assert r.retained_pct == pytest.approx(100 * retained / signup if signup else 0.0, abs=0.0005)
            if r.date == day(9):
                one = retention.cohort_retention(df, *windows).first()
                assert tuple(one) == (r.signup, r.retained, r.retained_pct)


def test_retention_by_day_over_several_words_of_days(spark):
    rows, df = random_log(spark, 3, days=150, size=600)
    targets = Period(day(-5), day(215))
    result = {r.date: (r.signup, r.retained) for r in retention.cohort_by_day(df, targets, (60, 31), (30, 1)).collect()}
    expected = {
        d: brute_retention(
            rows,
            Period(d - timedelta(days=60), d - timedelta(days=31)),
            Period(d - timedelta(days=30), d - timedelta(days=1)),
        )
        for d in targets.days()
    }
    assert result == expected
    assert max(retained for _, retained in expected.values()) > 5


def test_retained_and_churned_add_up(spark, small):
    df = log_from_events(spark, small)
    signup, active = Period(date(2024, 1, 1), date(2024, 1, 15)), Period(date(2024, 1, 16), date(2024, 1, 30))
    row = retention.cohort_retention(df, signup, active).first()
    assert row.signup - row.retained == retention.churned_ids(df, signup, active).count()


def test_no_signups_give_zero(spark):
    df = log(spark, {**VISIT, "log_date": DAY, "id": "a"})
    period = Period(DAY, day(5))
    assert tuple(retention.cohort_retention(df, period, period).first()) == (0, 0, 0.0)
    assert [tuple(r)[1:] for r in retention.cohort_by_day(df, period, (3, 1), (3, 1)).collect()] == [(0, 0, 0.0)] * 6


def test_empty_id_counts_in_retention_and_missing_id_does_not(spark):
    df = log(spark, {**SIGNUP, "log_date": DAY, "id": ""}, {**SIGNUP, "log_date": DAY, "id": None})
    period = Period(DAY, DAY)
    assert tuple(retention.cohort_retention(df, period, period).first()) == (1, 1, 100.0)


def test_missing_api_is_no_signup_and_no_activity(spark):
    df = log(spark, {"log_date": DAY, "id": "a", "method": "POST", "code": "200"})
    period = Period(DAY, DAY)
    assert tuple(retention.cohort_retention(df, period, period).first()) == (0, 0, 0.0)
    assert retention.cohort_by_day(df, Period(day(1), day(1)), (1, 1), (1, 1)).first().signup == 0


def test_published_records(spark):
    df = log(
        spark,
        {**VISIT, "log_date": DAY, "id": "a"},
        {**SIGNUP, "log_date": DAY, "id": "a", "role": "parent"},
        {"api": Endpoints().users + "/1", "method": "DELETE", "code": "200", "log_date": DAY, "role": ""},
    )
    unique = as_unique_stats(activity.unique_counts(df, DAY))
    assert [(f.name, f.dataType) for f in unique.schema] == [(f.name, f.dataType) for f in UNIQUE_SCHEMA]
    assert {r._type for r in unique.collect()} == {"user1d-nodev", "user7d-nodev", "user30d-nodev"}
    assert unique.first()._index == "unique-stats-2024"

    accum = as_accum_stats(lifecycle(df))
    assert [(f.name, f.dataType) for f in accum.schema] == [(f.name, f.dataType) for f in ACCUM_SCHEMA]
    assert {(r.kind, r._type, r.role) for r in accum.collect()} == {("user", "user", "parent"), ("user-del", "user", "_null")}

    # In January the month of the sign-ups lies in the year before; the index stays with the target day.
    one = retention.cohort_by_day(df, Period(day(1), day(1)), (1, 1), (1, 1))
    row = as_cohort(one).first()
    assert as_cohort(one).columns == COHORT_SCHEMA.names
    assert row._index == "cohort-2024" and row._type == "202311" and row.lastMonths == 1
    assert (row.signup, row.last1M, row.last1M_cnt) == (1, 100.0, 1)
    assert row.submit == "Tue Jan 02 00:00:00 UTC 2024"


def test_kinds_are_found_in_one_scan(spark, small):
    df = log_from_events(spark, small)
    together = Counter(r.kind for r in lifecycle(df).collect())
    assert together == {kind: lifecycle(df, [kind]).count() for kind in KINDS}


def test_curves_by_day_are_the_curves_of_each_day(spark, medium):
    log = log_from_events(spark, medium).cache()
    targets = run_period("20240131", 5)
    one_scan = retention.curve_by_day(retention.marks(log, targets.widen(before=21, after=-1)), targets, 7, 2)
    ids = retention.curve_by_day(retention.daily_ids(log, targets.widen(before=21, after=-1)), targets, 7, 2)
    expected = []
    for day in targets.days():
        first = day - timedelta(days=21)
        periods = [Period(first + timedelta(days=7 * k), first + timedelta(days=7 * k + 6)) for k in range(3)]
        rows = retention.cohort_curve(log, periods[0], periods[1:]).collect()
        expected += [(day, r.lag, r.signup, r.retained, r.retained_pct) for r in rows]
    assert sorted(map(tuple, one_scan.collect())) == sorted(map(tuple, ids.collect())) == sorted(expected)
    assert any(row[3] for row in expected)

"""How many of the ids that signed up in one period were active in another."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.functions import predicates
from daytally.functions.periods import Period, calendar
from daytally.schema import Endpoints

_WORD = 64


def _calls(log: DataFrame, reach: Period) -> DataFrame:
    """The lines that can count: a sign-up is a real call with an id too. Stated by itself, it reaches the scan."""
    return log.where(reach.contains(F.col("log_date")) & predicates.cohort_activity())


def _is_signup(endpoints: Endpoints) -> Column:
    return F.coalesce(predicates.signup(endpoints), F.lit(False))


def _percent(part: Column, whole: Column) -> Column:
    """Share in percent with three decimals; 0 when there is no whole."""
    share = F.when(whole != 0, F.round(part.cast("double") / whole * 100, 3))
    return F.coalesce(share, F.lit(0.0))


def active_ids(log: DataFrame) -> DataFrame:
    return log.where(predicates.cohort_activity()).select("id").distinct()


def id_flags(log: DataFrame, signup: Period, activity: Sequence[Period], endpoints: Endpoints) -> DataFrame:
    """Per id: whether it signed up, and whether it was active in each activity period. One scan, one shuffle."""
    day = F.col("log_date")
    marks = {"signed_up": signup.contains(day) & _is_signup(endpoints)}
    for number, period in enumerate(activity):
        marks[f"active_{number}"] = period.contains(day)
    reach = Period(min(p.first for p in [signup, *activity]), max(p.last for p in [signup, *activity]))
    return _calls(log, reach).groupBy("id").agg(*[F.max(mark).alias(name) for name, mark in marks.items()])


def churned_ids(log: DataFrame, signup: Period, activity: Period, endpoints: Endpoints = Endpoints()) -> DataFrame:
    """Ids that signed up but were not active."""
    return id_flags(log, signup, [activity], endpoints).where("signed_up and not active_0").select("id")


def cohort_curve(
    log: DataFrame, signup: Period, lags: Sequence[Period], endpoints: Endpoints = Endpoints()
) -> DataFrame:
    """Retention of one sign-up period in several activity periods: one row per lag, numbered from 1."""
    signed_up = F.col("signed_up")
    totals = id_flags(log, signup, lags, endpoints).agg(
        F.count_if(signed_up).alias("signup"),
        *[F.count_if(signed_up & F.col(f"active_{n}")).alias(f"retained_{n}") for n in range(len(lags))],
    )
    per_lag = F.array(
        *[
            F.struct(F.lit(n + 1).alias("lag"), F.col(f"retained_{n}").alias("retained"))
            for n in range(len(lags))
        ]
    )
    return totals.select("signup", F.inline(per_lag)).select(
        "lag", "signup", "retained", _percent(F.col("retained"), F.col("signup")).alias("retained_pct")
    )


def cohort_retention(
    log: DataFrame, signup: Period, activity: Period, endpoints: Endpoints = Endpoints()
) -> DataFrame:
    """One row: ids signed up, ids of those that were active, and their share in percent."""
    return cohort_curve(log, signup, [activity], endpoints).drop("lag")


def marks(log: DataFrame, reach: Period, endpoints: Endpoints = Endpoints()) -> DataFrame:
    """Per line that counts: log_date, id, and whether it is a sign-up."""
    return _calls(log, reach).select("log_date", "id", _is_signup(endpoints).alias("signed_up"))


def daily_ids(log: DataFrame, period: Period, endpoints: Endpoints = Endpoints()) -> DataFrame:
    """The ids of each day, with whether they signed up on it: log_date, id, signed_up.

    Stored by day, it stands for the log in `windows_by_day`: the days of an id are merged there, whichever way they come.
    """
    return marks(log, period, endpoints).groupBy("log_date", "id").agg(F.max("signed_up").alias("signed_up"))


def reach_of(targets: Period, signup_days: tuple[int, int], activity: Sequence[tuple[int, int]]) -> Period:
    """All days that any window of any target day has."""
    windows = [signup_days, *activity]
    return targets.widen(before=max(w[0] for w in windows), after=-min(w[1] for w in windows))


def windows_by_day(
    marked: DataFrame, targets: Period, signup_days: tuple[int, int], activity: Sequence[tuple[int, int]]
) -> DataFrame:
    """Per target day with sign-ups: date, signup, and retained_0, retained_1, … for the activity windows.

    `marked` is of `marks` or `daily_ids`, or parts of both. The day tuples say how many days before the target day each
    window starts and ends, as in `(60, 31)` and `(30, 1)`. Each id is reduced to two sets of days, on which it signed up
    and was active, held as bits of 64-day words; a window of a target day is then a bit mask. One shuffle by id.
    """
    reach = reach_of(targets, signup_days, activity)
    words = range(-(-len(reach) // _WORD))
    number = F.datediff(F.col("log_date"), F.lit(reach.first))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), number % _WORD)

    def day_bits(mark: Column, word: int) -> Column:
        in_word = number.between(word * _WORD, (word + 1) * _WORD - 1)
        return F.coalesce(F.bit_or(F.when(mark & in_word, bit)), F.lit(0).cast("bigint"))

    days_per_id = (
        marked.where(reach.contains(F.col("log_date")))
        .groupBy("id")
        .agg(
            *[day_bits(F.col("signed_up"), word).alias(f"signup_{word}") for word in words],
            *[day_bits(F.lit(True), word).alias(f"active_{word}") for word in words],
        )
        .where(_any([F.col(f"signup_{word}") != 0 for word in words]))
    )

    masks = {"offset": np.arange(len(targets))}
    windows = {"signup": signup_days} | {f"active_{n}": window for n, window in enumerate(activity)}
    for name, (farthest, nearest) in windows.items():
        first_days = [(day - reach.first).days - farthest for day in targets.days()]
        for word in words:
            masks[f"{name}_mask_{word}"] = _window_masks(first_days, farthest - nearest + 1, word)
    zipped = F.arrays_zip(*[F.lit(values).alias(name) for name, values in masks.items()])

    def in_window(days: str, window: str) -> Column:
        return _any([F.col(f"{days}_{word}").bitwiseAND(F.col(f"{window}_mask_{word}")) != 0 for word in words])

    return (
        days_per_id.select("*", F.inline(zipped).alias(*masks))
        .where(in_window("signup", "signup"))
        .groupBy(F.date_add(F.lit(targets.first), F.col("offset").cast("int")).alias("date"))
        .agg(
            F.count("*").alias("signup"),
            *[F.count_if(in_window("active", f"active_{n}")).alias(f"retained_{n}") for n in range(len(activity))],
        )
    )


def retention_by_day(
    marked: DataFrame, targets: Period, signup_days: tuple[int, int], activity_days: tuple[int, int]
) -> DataFrame:
    """One row per target day: date, signup, retained and their share in percent, from `marks` or `daily_ids`."""
    return _lagged(marked, targets, signup_days, [activity_days]).drop("lag")


def curve_by_day(marked: DataFrame, targets: Period, days: int, lags: int) -> DataFrame:
    """Retention curves of all target days from one reading: date, lag, signup, retained, retained_pct.

    Of the `days * (lags + 1)` days before a target day the first `days` are those of the sign-ups; lag k is the k-th
    stretch of `days` days after them.
    """
    far = [(days * (lags + 1 - k), days * (lags - k) + 1) for k in range(lags + 1)]
    return _lagged(marked, targets, far[0], far[1:])


def _lagged(
    marked: DataFrame, targets: Period, signup_days: tuple[int, int], activity: Sequence[tuple[int, int]]
) -> DataFrame:
    totals = windows_by_day(marked, targets, signup_days, activity)
    days = calendar(marked.sparkSession, targets).select("date")
    lags = F.array(
        *[
            F.struct(F.lit(n + 1).alias("lag"), F.coalesce(f"retained_{n}", F.lit(0).cast("long")).alias("retained"))
            for n in range(len(activity))
        ]
    )
    # One row per target day on both sides.
    found = days.join(F.broadcast(totals), "date", "left").select(
        "date", F.coalesce("signup", F.lit(0).cast("long")).alias("signup"), F.inline(lags)
    )
    pct = _percent(F.col("retained"), F.col("signup")).alias("retained_pct")
    return found.select("date", "lag", "signup", "retained", pct)


def cohort_by_day(
    log: DataFrame,
    targets: Period,
    signup_days: tuple[int, int],
    activity_days: tuple[int, int],
    endpoints: Endpoints = Endpoints(),
) -> DataFrame:
    """`retention_by_day` straight from the log, in one scan."""
    reach = reach_of(targets, signup_days, [activity_days])
    return retention_by_day(marks(log, reach, endpoints), targets, signup_days, activity_days)


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions)


def _window_masks(first_days: Sequence[int], length: int, word: int) -> np.ndarray:
    """For each window, the bits of `word` that stand for its days."""
    every = [((1 << length) - 1) << first for first in first_days]
    return np.array([(bits >> (word * _WORD)) & ((1 << _WORD) - 1) for bits in every], dtype=np.uint64).view(np.int64)

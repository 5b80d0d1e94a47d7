"""Active users and classes: how many events each combination of dimensions had in trailing windows.

Counts add up, so one rollup per day serves every window of every target day, and each day is scanned once.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daytally.functions import normalize, predicates
from daytally.functions.periods import Period, parse_day, trailing

WINDOWS = (1, 7, 30)
SUBJECTS = ("user", "class")
DIMENSIONS = ("subject", "id", "role", "device", "country", "lang", "grade")

_ID_COLUMNS = {"user": "id", "class": "target_id"}


def active_events(log: DataFrame, subjects: Sequence[str] = SUBJECTS) -> DataFrame:
    """One row per counted event: `log_date` and the cleaned dimensions. An event may count for several subjects."""
    is_active = {"user": predicates.user_activity(), "class": predicates.class_activity()}
    if len(subjects) == 1:
        (subject,) = subjects
        counted = log.where(is_active[subject]).withColumns(
            {"subject": F.lit(subject), "subject_id": F.col(_ID_COLUMNS[subject])}
        )
    else:
        hits = F.array(
            *[
                F.struct(
                    F.lit(s).alias("subject"), F.col(_ID_COLUMNS[s]).alias("subject_id"), is_active[s].alias("active")
                )
                for s in subjects
            ]
        )
        counted = log.where(reduce(or_, [is_active[s] for s in subjects])).select("*", F.inline(hits)).where("active")
    return counted.select(
        "log_date",
        "subject",
        F.col("subject_id").alias("id"),
        "role",
        normalize.device_regex(F.col("device"), F.col("tag")).alias("device"),
        "country",
        normalize.language(F.col("language"), fill=True).alias("lang"),
        normalize.grade(F.col("grade")).alias("grade"),
    )


def daily_rollup(log: DataFrame, subjects: Sequence[str] = SUBJECTS) -> DataFrame:
    """Events per day and combination of dimensions."""
    return active_events(log, subjects).groupBy("log_date", *DIMENSIONS).agg(F.count("*").alias("unique_cnt"))


def without_device(daily: DataFrame) -> DataFrame:
    """Collapse device to `_all` and grade to 0 in a daily rollup."""
    kept = ["log_date", "subject", "id", "role", "country", "lang"]
    totals = daily.groupBy(*kept).agg(F.sum("unique_cnt").alias("unique_cnt"))
    return totals.withColumns({"device": F.lit("_all"), "grade": F.lit(0).cast("bigint")}).select(
        "log_date", *DIMENSIONS, "unique_cnt"
    )


def _per_window(totals: DataFrame, windows: Sequence[int]) -> DataFrame:
    """From one column per window, named by its length, to one row per window that has events."""
    rows = F.array(
        *[F.struct(F.lit(w).alias("window_days"), F.col(f"last_{w}").alias("unique_cnt")) for w in windows]
    )
    return (
        totals.select("date", *DIMENSIONS, F.inline(rows))
        .where("unique_cnt > 0")
        .select("date", "window_days", *DIMENSIONS, "unique_cnt")
    )


def unique_counts(
    log: DataFrame, day: date | str, subjects: Sequence[str] = SUBJECTS, windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """Counts for one target day straight from the log, in one shuffle for all windows."""
    day, age = parse_day(day), F.datediff(F.lit(parse_day(day)), F.col("log_date"))
    events = active_events(log, subjects).where(trailing(day, max(windows)).contains(F.col("log_date")))
    totals = events.groupBy(*DIMENSIONS).agg(*[F.count_if(age < w).alias(f"last_{w}") for w in windows])
    return _per_window(totals.withColumn("date", F.lit(day)), windows)


def rolling_counts(daily: DataFrame, targets: Period, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Counts for every target day and window from a daily rollup.

    The count of a day enters each window on that day and leaves it when the window has passed. Running totals of these
    few changes give the counts, which hold until the next change. The rollup crosses the network once, with at most
    one row per day and combination; everything after that happens inside the tasks. A window of one day is the rollup.
    """
    if list(windows) == [1]:
        days = daily.where(targets.contains(F.col("log_date")))
        return days.select(F.col("log_date").alias("date"), F.lit(1).alias("window_days"), *DIMENSIONS, "unique_cnt")
    count, names = F.col("unique_cnt"), [f"last_{w}" for w in windows]
    enter = F.struct(F.lit(0).alias("after"), *[count.alias(name) for name in names])
    leave = [
        F.struct(F.lit(w).alias("after"), *[(-count if v == w else F.lit(0).cast("bigint")).alias(f"last_{v}") for v in windows])
        for w in windows
    ]
    changes = (
        daily.where(targets.widen(before=max(windows) - 1).contains(F.col("log_date")))
        # Without the subject, which is a constant when there is one; a constant key would cost another shuffle.
        .repartition(*DIMENSIONS[1:])
        .select("log_date", *DIMENSIONS, F.inline(F.array(enter, *leave)))
        .select(F.date_add("log_date", F.col("after")).alias("from"), *DIMENSIONS, *names)
        .where(F.col("from") <= F.lit(targets.last))
    )
    in_order = Window.partitionBy(*DIMENSIONS).orderBy("from")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.greatest("from", F.lit(targets.first))
    last = F.coalesce(F.date_sub("next", 1), F.lit(targets.last))
    totals = (
        changes.select(
            "from",
            F.lead("from").over(in_order).alias("next"),
            *DIMENSIONS,
            *[F.sum(name).over(so_far).alias(name) for name in names],
        )
        .where((F.col(f"last_{max(windows)}") > 0) & (first <= last))
        .withColumn("date", F.explode(F.sequence(first, last)))
    )
    return _per_window(totals, windows)

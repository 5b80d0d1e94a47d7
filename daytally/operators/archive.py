"""Cut UTC logs into local (UTC+9) calendar days."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.functions import normalize
from daytally.functions.periods import Period

# Fixed value: 15:00 UTC, when a new day starts at UTC+9. Stamps are compared with it as text.
LOCAL_MIDNIGHT = "T15"


def _starts_with_date(ftime: Column) -> Column:
    text = F.substring(ftime, 1, 10)
    return F.coalesce(text.try_cast("date").cast("string") == text, F.lit(False))


def _candidates(targets: Period, ftime: Column) -> Column:
    """The local days of a stamp that starts with a date; for other text, every target day.

    Day `d` holds the text range from `(d-1)T15` to `dT15`, ends included, so the bare text `dT15` is in two days.
    """
    day, time = F.substring(ftime, 1, 10).try_cast("date"), F.expr("substring(ftime, 11)")
    next_day = F.date_add(day, 1)
    any_day = F.sequence(F.lit(targets.first), F.lit(targets.last))
    return (
        F.when(~_starts_with_date(ftime), any_day)
        .when(time < LOCAL_MIDNIGHT, F.array(day))
        .when(time > LOCAL_MIDNIGHT, F.array(next_day))
        .otherwise(F.array(day, next_day))
    )


def _holds(local_day: Column, ftime: Column) -> Column:
    cut = F.lit(LOCAL_MIDNIGHT)
    return ftime.between(
        F.concat(F.date_sub(local_day, 1).cast("string"), cut), F.concat(local_day.cast("string"), cut)
    )


def local_archive(log: DataFrame, targets: Period, late_days: int = 0) -> DataFrame:
    """The log lines of the local days in `targets`, all columns kept, with clean `grade` and `code` and `kr_date`.

    A local day takes its lines from the directories of its own and the previous UTC day. With `late_days`, lines
    that arrived in that many later directories count too.
    """
    start = f"{targets.first - timedelta(days=1)}{LOCAL_MIDNIGHT}"
    end = f"{targets.last}{LOCAL_MIDNIGHT}"
    ftime, kr_date = F.col("ftime"), F.col("kr_date")
    return (
        log.where(targets.widen(1, late_days).contains(F.col("log_date")) & ftime.between(start, end))
        .withColumn("kr_date", F.explode(_candidates(targets, ftime)))
        .where(targets.contains(kr_date) & (_starts_with_date(ftime) | _holds(kr_date, ftime)))
        .where(F.col("log_date").between(F.date_sub(kr_date, 1), F.date_add(kr_date, late_days)))
        .withColumns({"grade": normalize.grade(F.col("grade")), "code": normalize.code(F.col("code"))})
    )

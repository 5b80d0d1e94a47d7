"""Inclusive day ranges: run arguments, look-back windows, and the calendar as a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Period:
    """Days `first` to `last`, both included; empty when `first` is after `last`."""

    first: date
    last: date

    def __len__(self) -> int:
        return max((self.last - self.first).days + 1, 0)

    def days(self) -> list[date]:
        return [self.first + timedelta(days=i) for i in range(len(self))]

    def widen(self, before: int = 0, after: int = 0) -> Period:
        return Period(self.first - timedelta(days=before), self.last + timedelta(days=after))

    def contains(self, day: Column) -> Column:
        return day.between(F.lit(self.first), F.lit(self.last))


def parse_day(day: date | str) -> date:
    return day if isinstance(day, date) else datetime.strptime(day, "%Y%m%d").date()


def run_period(start: date | str, num_days: float | str) -> Period:
    """START, START-1, … over `num_days` days. The number may be text with decimals, which are cut off."""
    last = parse_day(start)
    return Period(last - timedelta(days=int(float(num_days)) - 1), last)


def span(one: date | str, other: date | str) -> Period:
    """All days between two days given in either order."""
    first, last = sorted((parse_day(one), parse_day(other)))
    return Period(first, last)


def trailing(day: date | str, n: int) -> Period:
    """The `n` days that end on, and include, `day`."""
    last = parse_day(day)
    return Period(last - timedelta(days=n - 1), last)


def preceding(day: date | str, n: int) -> Period:
    """The `n` days before `day`, which is left out."""
    return trailing(parse_day(day) - timedelta(days=1), n)


def calendar(spark: SparkSession, period: Period) -> DataFrame:
    """One row per day: `date` and the day before it, which a local day also reads."""
    day = F.date_add(F.lit(period.first), F.col("id").cast("int"))
    return spark.range(len(period)).select(day.alias("date"), F.date_sub(day, 1).alias("previous_date"))

"""Output records: fixed column order, run stamp, and index and type names derived from the target day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.functions.periods import Period
from daytally.schema import ACCUM_SCHEMA, COHORT_SCHEMA, UNIQUE_SCHEMA


def run_stamp(day: Column) -> Column:
    """Midnight of the target day in the session time zone, like `Tue Oct 09 00:00:00 UTC 2018`."""
    return F.date_format(day, "EEE MMM dd HH:mm:ss zzz yyyy")


def day_text(day: Column) -> Column:
    """`yyyyMMdd`. Cutting up the ISO text is much cheaper per row than a date formatter."""
    return F.replace(day.cast("string"), F.lit("-"), F.lit(""))


def index_name(prefix: str, day: Column) -> Column:
    return F.concat(F.lit(f"{prefix}-"), F.substring(day.cast("string"), 1, 4))


def _per_day(day: Column, targets: Period | None, prefix: str) -> dict[str, Column]:
    """Text, stamp and index of the target day. With `targets`, worked out once per day and looked up by its number."""
    made = {"date": day_text, "timeStamp": run_stamp, "_index": lambda d: index_name(prefix, d)}
    if targets is None:
        return {name: of(day) for name, of in made.items()}
    number = F.datediff(day, F.lit(targets.first))
    # Arrays of constants, which the planner evaluates.
    return {name: F.get(F.array(*[of(F.lit(d)) for d in targets.days()]), number) for name, of in made.items()}


def _record(df: DataFrame, schema, values: dict[str, Column]) -> DataFrame:
    return df.select(*[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])


def as_unique_stats(counts: DataFrame, targets: Period | None = None) -> DataFrame:
    """Records from trailing-window counts, whose days are all in `targets` if that is given."""
    return _record(
        counts,
        UNIQUE_SCHEMA,
        {
            **_per_day(F.col("date"), targets, "unique-stats"),
            "_type": F.concat(F.col("subject"), F.col("window_days").cast("string"), F.lit("d-nodev")),
        },
    )


def as_accum_stats(events: DataFrame, targets: Period | None = None) -> DataFrame:
    """Records from lifecycle events, whose days are all in `targets` if that is given.

    Deletions keep the type of what was deleted; `kind` tells them apart.
    """
    return _record(
        events,
        ACCUM_SCHEMA,
        {
            **_per_day(F.col("log_date"), targets, "accum-stats"),
            "_type": F.replace(F.col("kind"), F.lit("-del"), F.lit("")),
        },
    )


def as_cohort(retention: DataFrame, last_months: int = 1) -> DataFrame:
    """Records from retention per target day. The type names the month the sign-ups are meant to come from."""
    day = F.col("date")
    return _record(
        retention,
        COHORT_SCHEMA,
        {
            "date": day_text(day),
            "lastMonths": F.lit(last_months),
            "submit": run_stamp(day),
            "timestamp": run_stamp(day),
            "_index": index_name("cohort", day),
            "_type": F.date_format(F.add_months(day, -last_months - 1), "yyyyMM"),
            "last1M": F.col("retained_pct"),
            "last1M_cnt": F.col("retained"),
        },
    )

"""Cleaning rules. Each metric family has its own; they differ on purpose, because the numbers depend on them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.schema import NULL_GRADE, NULL_TEXT

# Defaults for columns a log may lack.
COLUMN_DEFAULTS: Mapping[str, object] = {
    "grade": NULL_GRADE,
    "role": NULL_TEXT,
    "device": NULL_TEXT,
    "country": NULL_TEXT,
    "language": NULL_TEXT,
}


def ensure_columns(df: DataFrame, defaults: Mapping[str, object] = COLUMN_DEFAULTS) -> DataFrame:
    """Add the columns that `df` lacks, filled with their default; columns it has stay as they are."""
    return df.withColumns(
        {
            name: F.lit(value).cast("bigint") if isinstance(value, int) else F.lit(value)
            for name, value in defaults.items()
            if name not in df.columns
        }
    )


def grade(raw: Column) -> Column:
    """Missing grade becomes -999, decimals are cut off, and text that is no number becomes NULL."""
    number = raw.try_cast("decimal(38,18)").try_cast("bigint")
    return F.when(raw.isNull(), F.lit(NULL_GRADE).cast("bigint")).otherwise(number)


def code(raw: Column) -> Column:
    return F.coalesce(raw.cast("string"), F.lit(NULL_TEXT))


def language(raw: Column, fill: bool) -> Column:
    """Activity counts fill a missing language; lifecycle records keep it NULL."""
    return F.coalesce(raw, F.lit(NULL_TEXT)) if fill else raw


def device_regex(device: Column, tag: Column) -> Column:
    """Activity rule: drop any character followed by `event`; a missing device falls back to the cleaned tag."""

    def clean(text: Column) -> Column:
        return F.regexp_replace(text, ".event", "")

    return F.coalesce(clean(device), clean(tag), F.lit(NULL_TEXT))


def device_literal(device: Column) -> Column:
    """Lifecycle rule: drop the exact text `.event`; a missing device is the text `null`."""
    return F.replace(F.coalesce(device, F.lit("null")), F.lit(".event"), F.lit(""))


def local_date(ftime: Column, zone: str = "Asia/Seoul") -> Column:
    """Calendar day of a UTC stamp in `zone`, whatever the session time zone is."""
    utc = F.substring(ftime, 1, 19).try_cast("timestamp_ntz")
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc))

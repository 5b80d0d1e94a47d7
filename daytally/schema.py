"""Columns read and written, null sentinels, and the endpoints that mark lifecycle events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The sentinels that stand for a missing value in the output.
NULL_TEXT = "_null"
NULL_GRADE = -999

# Api markers that are no real calls.
PAGE_MOVE = "page_move"
API_MARKERS = (PAGE_MOVE, NULL_TEXT)

# The resource types that count as writing in a class.
WRITING_TYPES = (
    "texthome",
    "filehome",
    "photohome",
    "videohome",
    "sharehome",
    "photos",
    "notice",
)


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# Raw JSON lines. `code` and `grade` hold numbers or text, so both are read as text.
RAW_SCHEMA = T.StructType(
    _strings(
        "ftime",
        "api",
        "method",
        "code",
        "id",
        "role",
        "device",
        "tag",
        "country",
        "language",
        "grade",
        "target_type",
        "target_id",
        "resource_type",
    )
)

# What every operator expects: the raw columns, the UTC day of the directory, and a number that orders events
# which share one `ftime`.
LOG_SCHEMA = T.StructType(
    [T.StructField("event_id", T.LongType()), T.StructField("log_date", T.DateType())] + RAW_SCHEMA.fields
)

UNIQUE_SCHEMA = T.StructType(
    _strings("id", "role", "device", "country")
    + [T.StructField("unique_cnt", T.LongType())]
    + _strings("date", "lang")
    + [T.StructField("grade", T.LongType())]
    + _strings("timeStamp", "_index", "_type")
)

# `kind` names the output directory; it differs from `_type` for deletions.
ACCUM_SCHEMA = T.StructType(
    _strings("role", "device", "country", "date", "lang")
    + [T.StructField("grade", T.LongType())]
    + _strings("timeStamp", "_index", "_type", "kind")
)

COHORT_SCHEMA = T.StructType(
    [T.StructField("signup", T.LongType())]
    + _strings("date")
    + [T.StructField("lastMonths", T.IntegerType())]
    + _strings("submit", "timestamp", "_index", "_type")
    + [T.StructField("last1M", T.DoubleType()), T.StructField("last1M_cnt", T.LongType())]
)


@dataclass(frozen=True)
class Endpoints:
    """Hosts of the service whose log is analysed."""

    www: str = "https://www.example.com"
    oauth: str = "https://oauth.example.com"

    @property
    def users(self) -> str:
        return f"{self.www}/api/users"

    @property
    def classes(self) -> str:
        return f"{self.www}/api/classes"

    @property
    def signup_urls(self) -> tuple[str, ...]:
        return (self.users, f"{self.oauth}/v1/oauth2/sign_up", f"{self.oauth}/api/users")

    @property
    def class_create_urls(self) -> tuple[str, ...]:
        return (self.classes,)

"""Read the log: day directories of JSON lines, or a Parquet table partitioned by UTC day."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.functions.periods import Period
from daytally.schema import LOG_SCHEMA, RAW_SCHEMA
from daytally.sources.catalogue import OWN_COLUMNS, RAW_PREFIX, catalogue, columns_of
from daytally.sources.files import day_glob, day_of, lines_of, present_days

# Names and values, as text, of what a line has besides the columns of the read.
REST = T.StructField("more_columns", T.MapType(T.StringType(), T.StringType()))


class MissingDays(ValueError):
    """The log lacks days that were asked for."""


def column_names(spark: SparkSession, root: str, period: Period, fmt: str = "json") -> list[str]:
    """The names of the columns that any line of the period has, with raw names that are ours prefixed.

    JSON lines are all looked through once, for names only, up to the bound of the catalogue. A Parquet table tells its
    names in the footers of the period's files.
    """
    if fmt == "json":
        return columns_of(catalogue(spark, root, period))[0]
    return table_columns(spark, root, period)[0]


def absent_columns(
    spark: SparkSession, root: str, period: Period, names: Iterable[str], fmt: str = "json"
) -> set[str]:
    """Those of `names` that no line of the period has; none of them where there are no files. One pass for all names."""
    names = sorted(set(names))
    if fmt != "json":
        return set(names) - set(column_names(spark, root, period, fmt))
    if not names or not present_days(spark, root, period):
        return set()
    keys = F.json_object_keys("value")
    met = [F.coalesce(F.bool_or(F.array_contains(keys, name)), F.lit(False)) for name in names]
    return {name for name, found in zip(names, lines_of(spark, root, period).agg(*met).first(), strict=True) if not found}


def table_columns(spark: SparkSession, root: str, period: Period) -> tuple[list[str], bool]:
    """The columns that the footers of a Parquet log's files tell of, and whether it has a column for the rest."""
    days = sorted(present_days(spark, root, period, "parquet"))
    if not days:
        return [], False
    paths = [f"{root}/log_date={day}" for day in days]
    found = spark.read.option("basePath", root).option("mergeSchema", True).parquet(*paths).columns
    return sorted(set(found) - set(OWN_COLUMNS)), REST.name in found


def log_schema(extra: Sequence[str] = (), rest: bool = False) -> T.StructType:
    """The columns of the log; those that are not known are text, so that they are the same on every day."""
    more = [T.StructField(name, T.StringType()) for name in extra if name not in LOG_SCHEMA.names]
    return T.StructType(LOG_SCHEMA.fields + more + [REST] * rest)


def read_logs(
    spark: SparkSession,
    root: str,
    period: Period,
    *,
    fmt: str = "json",
    file_glob: str | None = None,
    extra: Sequence[str] = (),
    rest: bool = False,
    allow_missing: bool = False,
) -> DataFrame:
    """The log lines of `period`, with `log_date` and `event_id`, and the columns in `extra` as text.

    With `rest`, a map `more_columns` holds what a line has besides, as text, and is null where that is nothing.

    JSON (`fmt="json"`) is read from `root/logs_yyyyMMdd/` under a declared schema of text, so there is no inference
    pass; nested values are JSON text, and malformed lines are dropped (`catalogue` counts them). `file_glob` limits
    the file names, e.g. `*-10_*.gz` for one hour of each day. JSON lines have no number of their own: they get a hash
    of their content, which orders lines that share a stamp in the same way on every run.

    Parquet (`fmt="parquet"`) is a table with the columns of `LOG_SCHEMA`, partitioned by `log_date`.

    A day without files is an error, or has no rows if `allow_missing` is set.
    """
    if file_glob and fmt != "json":
        raise ValueError("file patterns are for JSON logs; a Parquet table has no file per hour")
    present = present_days(spark, root, period, fmt)
    if not allow_missing and (missing := sorted(set(period.days()) - present)):
        raise MissingDays(", ".join(map(str, missing)))
    if not present:
        return spark.createDataFrame([], log_schema(extra, rest))
    if fmt == "parquet":
        return spark.read.schema(log_schema(extra, rest)).parquet(root).where(period.contains(F.col("log_date")))
    known = [*RAW_SCHEMA.names, *(name for name in extra if name not in LOG_SCHEMA.names)]
    in_file = {name: name.removeprefix(RAW_PREFIX) if name.removeprefix(RAW_PREFIX) in OWN_COLUMNS else name for name in known}
    schema = T.StructType([T.StructField(name, T.StringType()) for name in in_file.values()])
    if rest:
        return _with_rest(lines_of(spark, root, period, file_glob), in_file, schema)
    reader = spark.read.schema(schema).option("mode", "DROPMALFORMED")
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    raw = reader.json(day_glob(root, period))
    return raw.select(
        F.xxhash64(*in_file.values()).alias("event_id"),
        day_of(F.col("_metadata.file_path")).alias("log_date"),
        *[F.col(source).alias(name) for name, source in in_file.items()],
    )


def _with_rest(lines: DataFrame, in_file: Mapping[str, str], schema: T.StructType) -> DataFrame:
    """Lines taken apart one by one, as the rest of a line is only known from its text."""
    value, corrupt = F.col("value"), T.StructField("_corrupt_record", T.StringType())
    other = F.map_filter(F.from_json(value, REST.dataType), lambda name, _: ~name.isin(*in_file.values()))
    parsed = lines.select(
        day_of(F.col("_metadata.file_path")).alias("log_date"),
        F.from_json(value, T.StructType([*schema.fields, corrupt])).alias("line"),
        F.when(F.size(other) > 0, other).alias(REST.name),
    )
    fields = {name: F.col("line").getField(source) for name, source in in_file.items()}
    return parsed.where("line._corrupt_record is null").select(
        F.xxhash64(*fields.values(), F.to_json(REST.name)).alias("event_id"),
        "log_date",
        *[column.alias(name) for name, column in fields.items()],
        REST.name,
    )


def line_quality(spark: SparkSession, root: str, period: Period) -> DataFrame:
    """Per day: lines, malformed lines, and lines whose grade is no number."""
    totals = catalogue(spark, root, period).where("name is null")
    return totals.select("log_date", "lines", "malformed", "bad_grades")

"""What the JSON lines of each day hold: the names of their columns, and how many lines there are and are no good.

One pass over the text gives all of it, so that a job looks a day through once, however many names it asks about, and
not at all where the result was kept. The counts come from grouping and not from accumulators, so that tasks which run
twice count once.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.functions.periods import Period
from daytally.schema import RAW_SCHEMA
from daytally.sources.files import day_of, lines_of, list_files

# Columns of ours; a raw column of the same name is kept with this prefix.
OWN_COLUMNS = ("event_id", "log_date", "kr_date", "more_columns")
RAW_PREFIX = "raw_"
#: Most names that are kept of a day, and most columns that a read has; lines with other names keep them in a map.
MAX_NAMES = 1000
# `name` is null in the row of the day itself, which has `names`, the number of distinct names.
CATALOGUE_SCHEMA = T.StructType(
    [T.StructField("log_date", T.DateType()), T.StructField("name", T.StringType())]
    + [T.StructField(name, T.LongType()) for name in ("lines", "malformed", "bad_grades", "names")]
)


def catalogue(
    spark: SparkSession, root: str, period: Period, file_glob: str | None = None, max_names: int = MAX_NAMES
) -> DataFrame:
    """One row per day and name with the number of lines that have it, and one per day with a null name for all lines.

    Of more than `max_names` names of a day, those of the log's own columns and then the most frequent are kept; `names`
    tells how many there were. A line that is blank is none; one that is no JSON object is malformed, and its names do
    not count. A name that repeats in a line counts once.
    """
    if list_files(spark, root, period) is None:
        return spark.createDataFrame([], CATALOGUE_SCHEMA)
    value, grade, line = F.col("value"), F.col("parsed.grade"), F.col("name").isNull()
    lines = lines_of(spark, root, period, file_glob)
    parsed = F.from_json(value, "grade string, _corrupt_record string")
    lines = lines.select(day_of(F.col("_metadata.file_path")).alias("log_date"), value, parsed.alias("parsed"))
    malformed = F.col("parsed._corrupt_record").isNotNull()
    keys = F.when(~malformed, F.array_distinct(F.json_object_keys(value)))
    nothing = F.array(F.lit(None).cast("string"))
    named = lines.select(
        "log_date",
        malformed.alias("malformed"),
        (grade.isNotNull() & grade.try_cast("decimal(38,18)").isNull()).alias("bad_grade"),
        F.explode(F.concat(nothing, F.coalesce(keys, F.array().cast("array<string>")))).alias("name"),
    )
    counted = named.groupBy("log_date", "name").agg(
        F.count("*").alias("lines"),
        F.count_if(line & F.col("malformed")).alias("malformed"),
        F.count_if(line & F.col("bad_grade")).alias("bad_grades"),
    )
    # The row of the day first, then our columns, then by frequency. Spark limits each task's rows before they move.
    order = [line.desc(), F.col("name").isin(RAW_SCHEMA.names).desc(), F.col("lines").desc(), F.col("name")]
    kept = counted.withColumn("rank", F.row_number().over(Window.partitionBy("log_date").orderBy(*order)))
    kept = kept.where(F.col("rank") <= max_names + 1).drop("rank")
    totals = counted.groupBy("log_date").agg(F.count("name").alias("names"))
    kept = kept.join(totals, "log_date").withColumn("names", F.when(line, F.col("names")))
    return kept.select("log_date", "name", "lines", "malformed", "bad_grades", "names")


def columns_of(facts: DataFrame, max_names: int = MAX_NAMES) -> tuple[list[str], bool]:
    """The columns that lines of the catalogued days have, and whether they have more than these.

    Raw names that are ours are prefixed. Names that differ in case only are one column, the more frequent one's.
    """
    frequent = facts.where(F.col("name").isNotNull()).groupBy("name").agg(F.sum("lines").alias("lines"))
    own = F.col("name").isin(RAW_SCHEMA.names).desc()
    rows = frequent.orderBy(own, F.col("lines").desc(), "name").limit(max_names + 1).collect()
    days = facts.groupBy("log_date").agg(F.max("names").alias("all"), F.count("name").alias("kept"))
    names = {}
    for row in rows[:max_names]:
        names.setdefault(row.name.lower(), row.name)
    more = len(names) < len(rows) or not days.where(F.col("all") > F.col("kept")).isEmpty()
    return sorted(RAW_PREFIX + name if name in OWN_COLUMNS else name for name in names.values()), more


@dataclass(frozen=True)
class DayLines:
    """What a day's lines are like."""

    log_date: date
    lines: int
    malformed: int
    bad_grades: int


def quality_of(facts: DataFrame) -> list[DayLines]:
    """Per day: lines, malformed lines, and lines whose grade is no number."""
    rows = facts.where(F.col("name").isNull()).select("log_date", "lines", "malformed", "bad_grades")
    return [DayLines(*row) for row in sorted(rows.collect())]

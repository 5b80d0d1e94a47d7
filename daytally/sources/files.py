"""The files of a log: JSON lines in day directories, or a Parquet table partitioned by UTC day."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions.periods import Period


def day_glob(root: str, period: Period) -> str:
    """One pattern for all day directories, `logs_yyyyMMdd`. Days without a directory match nothing."""
    return f"{root}/logs_{{{','.join(f'{day:%Y%m%d}' for day in period.days())}}}"


def day_of(path: Column) -> Column:
    return F.to_date(F.regexp_extract(path, r".*/logs_(\d{8})/", 1), "yyyyMMdd")


def path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def list_files(spark: SparkSession, root: str, period: Period, fmt: str = "json") -> DataFrame | None:
    """The files of the log by day: log_date, path, length, modificationTime. Nothing is read but the listing."""
    reader = spark.read.format("binaryFile")
    try:
        if fmt == "json":
            files = reader.load(day_glob(root, period)).withColumn("log_date", day_of(F.col("path")))
        else:
            files = reader.option("pathGlobFilter", "*.parquet").load(root)
            if "log_date" not in files.columns:
                return None
    except AnalysisException as error:
        if path_missing(error):
            return None
        raise
    files = files.select(F.col("log_date").cast("date").alias("log_date"), "path", "length", "modificationTime")
    return files.where(period.contains(F.col("log_date")))


def present_days(spark: SparkSession, root: str, period: Period, fmt: str = "json") -> set[date]:
    """The days of `period` that the log has files for. The cost is one listing; the result has one row per day."""
    files = list_files(spark, root, period, fmt)
    return set() if files is None else {row.log_date for row in files.select("log_date").distinct().collect()}


def lines_of(spark: SparkSession, root: str, period: Period, file_glob: str | None = None) -> DataFrame:
    """The lines of the period as text, but for blank ones."""
    reader = spark.read.option("pathGlobFilter", file_glob) if file_glob else spark.read
    return reader.text(day_glob(root, period)).where(F.btrim("value", F.lit(" \t\r")) != "")

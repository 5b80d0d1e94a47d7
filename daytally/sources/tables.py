"""Write results as partitioned Parquet that can be rerun, and read them back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.sources.files import path_missing


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    replaces: Column,
    *,
    compression: str = "none",
    rebalance: bool = True,
    max_records_per_file: int = 20_000_000,
) -> None:
    """Replace the partitions for which `replaces`, a condition on the partition columns, holds.

    `df` has rows for these partitions only. Partitions outside keep their files; those inside that no longer have
    rows are emptied, so a rerun leaves nothing behind.

    With `rebalance`, the rows of a partition are brought together in tasks of even size, however uneven the
    partitions are. Without it, every task writes its own files: right when each task holds few partitions.
    """
    spark = df.sparkSession
    before = _files(spark, path, df.schema, partition_by, replaces)
    rows = df.hint("rebalance", *partition_by) if rebalance else df
    (
        rows.write.mode("overwrite")
        .partitionBy(*partition_by)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .option("maxRecordsPerFile", max_records_per_file)
        .parquet(path)
    )
    if not before:
        return
    after = _files(spark, path, df.schema, partition_by, replaces)
    nothing = spark.createDataFrame([], T.StructType([f for f in df.schema.fields if f.name not in partition_by]))
    for stale in [partition for partition, file in before.items() if after.get(partition) == file]:
        folder = "/".join(f"{name}={value}" for name, value in zip(partition_by, stale, strict=True))
        nothing.write.mode("overwrite").option("compression", compression).parquet(f"{path}/{folder}")


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table written by `write_partitioned`; one that does not exist yet is empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if path_missing(error):
            return spark.createDataFrame([], schema)
        raise


def _files(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str], where: Column
) -> dict[tuple, str]:
    """The first file name of each partition, which tells whether the partition was written since.

    Comes from the listing of the folders: its cost grows with the number of files, not of rows.
    """
    keys = [F.regexp_extract("path", rf"/{name}=([^/]*)/", 1) for name in partition_by]
    keys = [F.url_decode(key).cast(schema[name].dataType).alias(name) for key, name in zip(keys, partition_by, strict=True)]
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    try:
        files = reader.load(path).select("path", *keys).where(where)
    except AnalysisException as error:
        if path_missing(error):
            return {}
        raise
    first = files.groupBy(*partition_by).agg(F.min("path"))
    return {tuple(row)[:-1]: row[-1] for row in first.collect()}

"""What several operators need: lower-casing, checkpoints, Arrow batches of bounded bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BATCH_ROWS = 512
BATCH_BYTES = 2 << 20


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters stay. Null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; where that is unset, one in the warehouse."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def cut(df: DataFrame) -> DataFrame:
    """Compute once and keep on shared storage, so that a lost executor costs nothing but its running tasks.

    Spark removes the files when the frame is no longer referenced and spark.cleaner.referenceTracking.cleanCheckpoints
    is on.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def bounded_batches(spark: SparkSession) -> None:
    """Send at most BATCH_ROWS texts to Python at once, unless the session names another number than Spark's own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def runs(texts: pa.Array, most: int = BATCH_BYTES) -> Iterator[pa.Array]:
    """Cut an array of texts into runs of about `most` bytes; a longer text stands alone."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if row > start and held + size > most:
            yield texts.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < len(texts):
        yield texts.slice(start)

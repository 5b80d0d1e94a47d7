"""Store an intermediate result where every executor can read it again."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint `df` in the folder of `checkpoints`, or in the one that the session names in `spark.checkpoint.dir`."""
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return df.checkpoint()


@contextmanager
def checkpoints(spark: SparkSession, folder: str) -> Iterator[None]:
    """Keep the checkpoints made inside in a folder of their own below `folder`, and delete it at the end."""
    context = spark.sparkContext
    before, own = context.getCheckpointDir(), f"{folder}/_checkpoints-{uuid.uuid4().hex}"
    context.setCheckpointDir(own)
    try:
        yield
    finally:
        path = context._jvm.org.apache.hadoop.fs.Path(own)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        if before:
            context.setCheckpointDir(before.rpartition("/")[0])

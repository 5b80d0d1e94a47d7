"""Carry the last known value forward along an ordered log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daytally.functions.lineage import cut_lineage


def sorted_runs(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Sort over the whole cluster and number the rows: `_row` grows along the order, `_run` is the sorted partition.

    Equal rows, however many, still fall into several runs, because a row number breaks ties. The sorted rows are
    checkpointed, so that every later step sees the same runs; the input is checkpointed too, because sorting reads it
    twice and it may be a scan of raw logs.
    """
    rows = cut_lineage(df.withColumn("_tie", F.monotonically_increasing_id()))
    numbered = rows.orderBy(*order, "_tie").drop("_tie").withColumn("_row", F.monotonically_increasing_id())
    # The upper bits of such a number are the number of the partition.
    return cut_lineage(numbered).withColumn("_run", F.shiftright("_row", 33))


def carry_forward(
    df: DataFrame, column: str, partition: Sequence[str], order: Sequence[str], initial: str
) -> DataFrame:
    """Replace an empty `column` by the last non-empty one before it; NULL counts as a value and is carried too.

    Within a sorted run a window carries the value. What comes before a run is put in front of it as one more row, so a
    partition may be of any size and have any number of runs.
    """
    # A struct around the value tells a carried NULL from "nothing to carry".
    known = F.when(F.col(column).isNull() | (F.col(column) != ""), F.struct(F.col(column).alias("value")))
    rows = sorted_runs(df.withColumn("_known", known), [*partition, *order])

    earlier_runs = Window.partitionBy(*partition).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    before_runs = (
        rows.groupBy(*partition, "_run")
        .agg(F.max_by("_known", F.when(F.col("_known").isNotNull(), F.col("_row"))).alias("_last"))
        .select(*partition, "_run", F.last("_last", ignorenulls=True).over(earlier_runs).alias("_known"))
        .withColumn("_row", F.lit(-1).cast("bigint"))
    )
    so_far = Window.partitionBy(*partition, "_run").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    nothing = F.struct(F.lit(initial).alias("value"))
    carried = F.coalesce(F.last("_known", ignorenulls=True).over(so_far), nothing)
    return (
        rows.unionByName(before_runs, allowMissingColumns=True)
        .withColumn(column, carried["value"])
        .where("_row >= 0")
        .select(*df.columns)
    )

"""Mix sources to target weights, with DataFrame functions only.

The words of each source are summed, the sums give each source a target and so a repetition rate, and every document is
taken floor(rate) times plus once more with a probability equal to the fraction, decided by a hash of its id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally.llm.common import cut

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
SEED = "mix"


def n_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the id alone, or on the text where there is no id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS
) -> DataFrame:
    """From rows of source and size, one row per source: source, source_size, target, rate.

    Sources in code point order, null last, take the weights in turn and share `share` of all words. A target stops at
    `most` times its source; what is left over goes to the others by weight, until none is above.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.array(*map(F.lit, weights))[(F.col("place") % len(weights)).cast("int")]
    sources = cut(_placed(sums).select("source", "source_size", weight.alias("weight")))
    cap = F.col("source_size") * most
    level, held = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > cap
        at = sources.agg(
            F.count_if(above).alias("held"),
            F.sum("source_size").alias("words"),
            F.sum(F.when(above, cap).otherwise(0)).alias("capped"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        if at.held == held or not at.free:
            break
        held, level = at.held, (share * at.words - at.capped) / at.free
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(level))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return sources.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def _placed(sources: DataFrame) -> DataFrame:
    """Add `place`, the row's number from 0 in the order of sources, without bringing all rows to one task."""
    runs = cut(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("run", F.spark_partition_id()))
    # One row per run, as many as the sort had partitions.
    before = runs.groupBy("run").agg(F.count("*").alias("n"))
    before = before.select("run", (F.sum("n").over(Window.orderBy("run")) - F.col("n")).alias("before"))
    in_run = F.row_number().over(Window.partitionBy("run").orderBy(F.col("source").asc_nulls_last()))
    return runs.withColumn("in_run", in_run).join(F.broadcast(before), "run").withColumn(
        "place", F.col("before") + F.col("in_run") - 1
    )


def mixed(docs: DataFrame, seed: str = SEED, **how) -> DataFrame:
    """One row per row of `docs` (doc_id, text, source): doc_id, size, source_size, target, taken.

    - A null text has no words; a null source is a source of its own, the last in order.
    - Without a doc_id the text decides the draw; rows that repeat an id are all taken equally often.
    - A source without words has target 0. An empty table gives an empty result.
    - Other columns, whatever their names, are not read.
    """
    drawn = draw(F.col("doc_id"), F.col("text"), seed)
    sized = cut(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), drawn.alias("drawn")))
    targets = source_targets(sized, **how).withColumnRenamed("source", "of")
    return sized.join(targets, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _times(F.col("drawn"))).alias("taken")
    )


def _times(drawn: Column) -> Column:
    whole = F.floor("rate")
    return whole + (drawn < F.col("rate") - whole).cast("long")


def mix(docs: DataFrame, seed: str = SEED, **how) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns and `copy` from 1."""
    targets = source_targets(docs.select("source", n_words(F.col("text")).alias("size")), **how)
    targets = targets.select(F.col("source").alias("_of"), F.col("rate").alias("_rate"))
    whole = F.floor("_rate")
    times = whole + (draw(docs["doc_id"], docs["text"], seed) < F.col("_rate") - whole).cast("long")
    rows = docs.join(targets, docs["source"].eqNullSafe(F.col("_of"))).withColumn("_times", times).where("_times > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))
    return rows.select(*[docs[c] for c in docs.columns if c != "copy"], copies.alias("copy"))

"""Exact deduplication by distributed most-significant-digit radix partitioning.

Documents are split by their bytes, from the front. A level splits every open group by the next block of bytes; the
blocks get wider from level to level, so that the number of levels grows with the logarithm of the longest text. A group
is closed when it has one member or when its block ends the text: then all its members have equal bytes. Equality is
decided by the bytes alone; the digest is an output column and, with the id, the name of a group.

A level counts its groups with map-side aggregation, so a group of any size moves one row per task, and joins the counts
back, which Spark splits where a group is hot. Only the rest of texts in open groups is kept for the next level.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import ascii_lower, cut

FIRST_BLOCK = 64
GROWTH = 8
_REST = 2**31 - 1


def exact_groups(docs: DataFrame, first_block: int = FIRST_BLOCK, growth: int = GROWTH) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; the largest doc_id of a group stays.

    - A null text is an empty one; all empty texts are one group. Texts of any length are compared in full.
    - A null doc_id is smaller than any other. In a group without ids keep_id is null and every member is kept, as
      nothing tells its members apart.
    - Rows that repeat both id and text share one verdict and count one by one in group_size; `without_copies` leaves one.
      Rows with the same id and different texts are judged each by its text.
    - An empty table gives an empty result. Other columns, whatever their names, are not read.
    """
    text = F.col("text")
    lowered = ascii_lower(text).cast("binary")
    rows = (
        docs.select("doc_id", lowered.alias("tail"))
        .select("doc_id", F.unhex(F.sha2("tail", 256)).alias("digest"), "tail")
        .select("doc_id", "digest", F.lit(None).cast("long").alias("group_id"), F.lit(b"").alias("group_digest"), "tail")
    )
    # The first level needs few bytes of each text: no need to lower-case all of it a second time.
    heads = docs.select(
        "doc_id",
        F.unhex(F.sha2(lowered, 256)).alias("digest"),
        F.lit(None).cast("long").alias("group_id"),
        F.lit(b"").alias("group_digest"),
        ascii_lower(F.substring(text, 1, first_block)).cast("binary").alias("tail"),
    )
    closed, width = [], first_block
    while True:
        split = cut(_level(rows, heads, width))
        closed.append(split.where("closed").drop("closed", "tail"))
        rows = heads = split.where("not closed").select("doc_id", "digest", "group_id", "group_digest", "tail")
        if rows.isEmpty():
            break
        width *= growth
    return reduce(DataFrame.unionAll, closed).select(
        "doc_id",
        F.col("group_id").alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("group_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _level(rows: DataFrame, heads: DataFrame, width: int) -> DataFrame:
    """Split the groups of `rows` by the next `width` bytes; `heads` has the same rows with at least those bytes."""
    block = F.substring("tail", 1, width).alias("block")
    groups = (
        heads.select("doc_id", "digest", "group_id", "group_digest", block)
        .groupBy("group_id", "group_digest", "block")
        .agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "digest")).alias("name"))
    )
    here = rows.select("*", block).alias("here")
    groups = groups.alias("groups")
    closed = (F.col("group_size") == 1) | (F.length("here.block") < width)
    return here.join(
        groups,
        F.col("here.group_id").eqNullSafe(F.col("groups.group_id"))
        & (F.col("here.group_digest") == F.col("groups.group_digest"))
        & (F.col("here.block") == F.col("groups.block")),
    ).select(
        "here.doc_id",
        "here.digest",
        F.col("name.doc_id").alias("group_id"),
        F.col("name.digest").alias("group_digest"),
        "group_size",
        closed.alias("closed"),
        F.when(~closed, F.substring("here.tail", width + 1, _REST)).alias("tail"),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns; of rows that repeat id and text, one stays.

    Rows without an id whose group has no id at all are told apart by nothing: one of each text stays.
    """
    groups = exact_groups(docs).where("group_size > 1").select("doc_id", "kept", "text_sha256")
    groups = cut(groups.groupBy("doc_id", "kept", "text_sha256").agg(F.count("*").alias("times")))
    digest = F.sha2(ascii_lower(F.col("text")).cast("binary"), 256)

    def of(marks: DataFrame, how: str) -> DataFrame:
        marks = marks.select(F.col("doc_id").alias("_mark_id"), F.col("text_sha256").alias("_mark_digest"))
        same = docs["doc_id"].eqNullSafe(F.col("_mark_id")) & (digest == F.col("_mark_digest"))
        return docs.join(marks, same, how)

    repeated = groups.where("kept and times > 1")
    rest = of(groups.where("not kept or times > 1"), "left_anti")
    if repeated.isEmpty():
        return rest
    once = of(repeated, "left_semi").withColumn("_digest", digest).dropDuplicates(["doc_id", "_digest"]).drop("_digest")
    return rest.unionByName(once)

"""Exact top-k search by inner product with MaxScore over shards of vectors.

The components of a vector are its terms, and a shard of the index holds one posting list per component, with the least
and the largest value in it. A query knows from these what a component can add at most. Components whose bounds together
stay below the k-th best score known so far are non-essential: the others' postings are traversed, and a vector is
probed in a non-essential component only while its score so far and the bounds of all that is left could still reach that
score. A shard whose bounds all together cannot reach it is passed over.

Scores known so far start with those of a bounded sample of vectors and rise from shard to shard within a task. Every
shard meets every block of queries; each meeting returns at most k vectors for a query, and these are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally.llm.common import bounded_batches, cut

SCALE = 1024
TOP = 10
QUERY_EVERY = 100
#: Bytes of the posting lists of a shard, and queries of a block.
SHARD_BYTES = 2 << 20
BLOCK_QUERIES = 512
#: Shards that share a copy of a block of queries.
SHARDS_A_COPY = 4
#: About so many vectors, whatever the size of the table, give the first bounds; they cost time only.
SAMPLE_VECTORS = 1024
#: Non-essential components that are probed in one step.
STEP = 8
_EXACT = float(2**53)

_SHARD = "ids binary, places binary, lists binary, n int, width int"
_FOUND = "query long, query_id long, vec_id long, place long, score long"


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(False))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pack rows (vec_id, place, x) into shards; vectors of other lengths stand in shards of their own."""
    held: dict[int, list[tuple]] = {}

    def packed(width: int) -> pa.RecordBatch:
        rows = held.pop(width)
        lists = np.ascontiguousarray(np.stack([r[2] for r in rows]).T) if width else np.zeros((0, len(rows)), np.int64)
        ids, places = (np.array([r[i] for r in rows], np.int64).tobytes() for i in (0, 1))
        return pa.RecordBatch.from_pydict(
            {"ids": [ids], "places": [places], "lists": [lists.tobytes()], "n": pa.array([len(rows)], pa.int32()), "width": pa.array([width], pa.int32())}
        )

    for batch in batches:
        ids, places = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("vec_id", "place"))
        vectors = batch.column("x")
        ends = vectors.offsets.to_numpy()
        values = vectors.values.to_numpy(zero_copy_only=False)
        for i, (low, high) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
            rows = held.setdefault(int(high - low), [])
            rows.append((ids[i], places[i], values[low:high].astype(np.int64)))
            if len(rows) * (high - low + 2) * 8 >= SHARD_BYTES:
                yield packed(int(high - low))
    for width in list(held):
        yield packed(width)


class _Lists:
    """The posting lists of a shard and their bounds."""

    def __init__(self, ids: bytes, places: bytes, lists: bytes, n: int, width: int):
        self.ids, self.places = np.frombuffer(ids, np.int64), np.frombuffer(places, np.int64)
        exact = np.frombuffer(lists, np.int64).reshape(width, n)
        self.low, self.high = exact.min(axis=1), exact.max(axis=1)
        self.most = max([0.0, *np.abs(self.low.astype(float)), *np.abs(self.high.astype(float))])
        self.lists, self.floats = exact, None

    def of(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Lists, query and slack: doubles if they hold every score exactly, else 64-bit integers with bounds in doubles."""
        if self.most * np.abs(query.astype(float)).max(initial=0) * max(1, len(query)) < _EXACT:
            if self.floats is None:
                self.floats = self.lists.astype(np.float64)
            return self.floats, query.astype(np.float64), 0.0
        return self.lists, query, 1e-12

    def best(self, query: np.ndarray, own: int, least: float, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the `top` best vectors but the one at place `own`, among those that reach `least`."""
        shared = min(len(query), len(self.lists))  # a component that one of the two lacks adds nothing
        lists, q, slack = self.of(query[:shared])
        bounds = np.maximum(q.astype(float) * self.low[:shared], q.astype(float) * self.high[:shared])
        order = np.argsort(-bounds, kind="stable")
        left = np.concatenate([np.cumsum(bounds[order][::-1])[::-1], [0.0]])
        slack *= np.abs(bounds).sum()
        if left[0] + slack < least:
            return np.zeros(0, int), np.zeros(0, np.int64)
        # Non-essential are the last components whose bounds together do not reach `least` when nothing is scored.
        split = int(np.argmax(left + slack < least)) if (left + slack < least).any() else shared
        at = np.arange(len(self.ids))
        score = q[order[:split]] @ lists[order[:split]] if split else np.zeros(len(at), lists.dtype)
        while True:
            alive = score.astype(float) + left[split] + slack >= least
            if not alive.all():
                at, score = at[alive], score[alive]
            if split >= shared or not len(at):
                break
            step = order[split : split + STEP]
            score = score + (q[step] @ lists[np.ix_(step, at)])
            split = min(split + STEP, shared)
        other = self.places[at] != own
        at, score = at[other], score[other].astype(np.int64)
        if len(at) > top:
            bar = np.partition(score, len(score) - top)[len(score) - top]
            at, score = at[score >= bar], score[score >= bar]
        # ~x turns the order of 64-bit integers around without overflow.
        best = np.lexsort((self.places[at], self.ids[at], ~score))[:top]
        return at[best], score[best]


def _searched(top: int):
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, float] = {}
        for batch in batches:
            for row in batch.to_pylist():
                shard = _Lists(row["ids"], row["places"], row["lists"], row["n"], row["width"])
                parts = []
                for query in row["queries"]:
                    place = query["place"]
                    least = known.get(place, -np.inf if query["least"] is None else float(query["least"]))
                    at, scores = shard.best(np.array(query["x"], np.int64), place, least, top)
                    if len(at) == top:
                        least = max(least, float(scores[-1]))
                    known[place] = least
                    if len(at):
                        named = np.full(len(at), place), np.full(len(at), query["vec_id"])
                        parts.append((*named, shard.ids[at], shard.places[at], scores))
                if parts:
                    columns = [np.concatenate(c).astype(np.int64) for c in zip(*parts, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "query_id", "vec_id", "place", "score"])

    return searched


def _merged(found: DataFrame, top: int) -> DataFrame:
    """The best of what shards have found; Spark cuts each task's share to `top` rows a query before they are moved."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "place")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _meetings(index: DataFrame, shards: int, queries: DataFrame, n_queries: int, top: int) -> DataFrame:
    """What each shard has for each query. Blocks are copied, so that the shards of a block are spread over tasks."""
    blocks, copies = (max(1, -(-n // most)) for n, most in ((n_queries, BLOCK_QUERIES), (shards, SHARDS_A_COPY)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda name, n: F.pmod(F.xxhash64(name), F.lit(n)).cast("int")
    packed = queries.groupBy(dealt("place", blocks).alias("block"))
    packed = packed.agg(F.collect_list(F.struct("place", "vec_id", "x", "least")).alias("queries")).withColumn("copy", every(copies))
    pairs = index.withColumn("copy", dealt("places", copies)).withColumn("block", every(blocks)).join(packed, ["block", "copy"])
    return pairs.mapInArrow(_searched(top), _FOUND)


def top_vectors(vectors: DataFrame, every: int = QUERY_EVERY, top: int = TOP, scale: int = SCALE) -> DataFrame:
    """For each row of `vectors` (vec_id, embedding) whose vec_id is divisible by `every`, the `top` other rows of the highest
    inner product: query_id, rank (from 1), vec_id, score, equal scores by ascending vec_id.

    Components count as floor(scale * component); scores are 64-bit integers, and a component too large for that takes the
    largest one.

    - A vector that is null or holds a null or a number that is not finite takes no part, nor does a row without vec_id.
    - Vectors of unequal length are compared in the components that both have; an empty vector scores 0 with all.
    - Each row is a candidate and a query by itself: rows that repeat an id find each other, and a repeated query gives its
      rows again.
    - An empty table, or one without queries, gives an empty result. Other columns, whatever their names, are not read.
    """
    bounded_batches(vectors.sparkSession)
    x = F.transform("embedding", lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long")).alias("x")
    rows = vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & finite(F.col("embedding")))
    # A place names a row; it is kept in the stored table, from which both the index and the queries are taken.
    rows = cut(rows.select(F.col("vec_id").cast("long").alias("vec_id"), x).withColumn("place", F.monotonically_increasing_id()))
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    n, n_queries = rows.agg(F.count("*"), F.count_if(is_query)).first()
    queries = rows.where(is_query).withColumn("least", F.lit(None).cast("long"))
    index = cut(rows.mapInArrow(_shards, _SHARD))
    # The k-th best score of any few vectors is no higher than that of all.
    part = min(1.0, SAMPLE_VECTORS / max(1, n))
    sample = rows.where(F.pmod(F.xxhash64("place", F.lit("sample")), F.lit(1 << 30)) <= int(part * (1 << 30)))
    sample = sample.repartition(1).mapInArrow(_shards, _SHARD)
    first = _merged(_meetings(sample, 1, queries, n_queries, top), top)
    first = first.groupBy("query").agg(F.when(F.count("*") == top, F.min("score")).alias("least"))
    queries = queries.drop("least").join(first, F.col("place") == F.col("query"), "left").drop("query")
    return _merged(_meetings(index, index.count(), queries, n_queries, top), top).select("query_id", "rank", "vec_id", "score")

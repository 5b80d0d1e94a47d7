"""Ranked lexical search over an index whose documents are grouped by their length normaliser.

All documents of one normaliser m are a stratum, cut into shards of bounded size. Within a shard the postings of a term
stand in the order of their tf, so that an impact, which depends on m and tf alone, is worked out once per tf and not once
per posting. From the largest impact of each of an item's terms follows what a document of the shard can score at most. A
task visits its shards for each item in falling order of these bounds and stops when the next one is below the k-th best
score it has; what the tasks have found is merged.

The index holds the postings of the terms that the items have; items are taken in blocks of bounded size, one index each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm.common import bounded_batches, cut, runs

TOP = 10
#: The share of the mean length in the normaliser, in percent.
SHARE = 90
SHARD_DOCS = 4096
#: Shards are looked over together up to about this many postings.
RUN_POSTINGS = 2_000_000
#: Bytes of item texts in a block; its terms and weights are sent to all tasks.
BLOCK_BYTES = 4 << 20
_SEGMENT = 1 << 20

_WORDS = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TO_WORDS = bytes((c if c in _WORDS else 0x20) for c in range(256)).lower()

_SHARD = "m long, ids array<long>, known array<boolean>, terms array<int>, docs array<int>, tfs array<long>"
_FOUND = "item long, doc_id long, score long"
_COUNTED = T.StructType(
    [T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.LongType()))]
)


def count_terms(text: bytes) -> Counter:
    """Terms of a text and how often each occurs: runs of ASCII letters, digits and all other characters beyond ASCII."""
    plain, counts, at = text.translate(_TO_WORDS), Counter(), 0
    while at < len(plain):  # in parts, so that a very long text needs no list of all its words
        end = at + _SEGMENT
        if end < len(plain):
            end = plain.find(b" ", end)
            end = len(plain) if end < 0 else end
        counts.update(plain[at:end].split())
        at = end
    return counts


def _counted(numbers):
    """Of each text the number of its terms, and those that have a number, with their tf."""

    @F.arrow_udf(_COUNTED)
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = numbers.value
        for texts in batches:
            n, terms, tfs = [], [], []
            for run in runs(texts):
                for text in run.cast(pa.binary()).to_pylist():
                    counts = count_terms(text or b"")
                    held = [(number, tf) for term, tf in counts.items() if (number := known.get(term)) is not None]
                    n.append(counts.total())
                    terms.append([h[0] for h in held])
                    tfs.append([h[1] for h in held])
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], _COUNTED.names
            )

    return counted


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards from rows (m, doc_id, terms, tfs) in the order of m."""
    held: list[tuple] = []

    def shard() -> pa.RecordBatch:
        ids = [r[1] for r in held]
        sizes = [len(r[2]) for r in held]
        terms, tfs = (np.concatenate([r[i] for r in held]) for i in (2, 3))
        docs = np.repeat(np.arange(len(held), dtype=np.int32), sizes)
        order = np.lexsort((docs, -tfs, terms))
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([held[0][0]], pa.int64()),
                one([0 if i is None else i for i in ids], pa.int64()),
                one([i is not None for i in ids], pa.bool_()),
                one(terms[order], pa.int32()),
                one(docs[order], pa.int32()),
                one(tfs[order], pa.int64()),
            ],
            names=["m", "ids", "known", "terms", "docs", "tfs"],
        )

    for batch in batches:
        m, ids = batch.column("m").to_pylist(), batch.column("doc_id").to_pylist()
        ends = batch.column("terms").offsets.to_numpy()
        terms, tfs = (batch.column(name).values.to_numpy() for name in ("terms", "tfs"))
        for i in range(len(m)):
            if held and (held[0][0] != m[i] or len(held) == SHARD_DOCS):
                yield shard()
                held = []
            part = slice(ends[i] - ends[0], ends[i + 1] - ends[0])
            held.append((m[i], ids[i], terms[part], tfs[part]))
    if held:
        yield shard()


class _Shard:
    def __init__(self, m: int, ids, known, terms, docs, tfs):
        self.ids, self.known, self.docs = ids, known, docs
        # One impact for each tf, whatever the number of postings.
        kinds, kind = np.unique(tfs, return_inverse=True)
        impacts = np.array([1_000_000_000 * int(tf) // (1000 * int(tf) + 8 * m) for tf in kinds], np.int64)
        self.impacts = impacts[kind]
        self.terms, self.starts = np.unique(terms, return_index=True)
        self.ends = np.append(self.starts[1:], len(terms))
        self.highest = self.impacts[self.starts] if len(terms) else np.zeros(0, np.int64)  # tf falls within a term

    def bound(self, terms: np.ndarray, weights: np.ndarray) -> int:
        """What a document of the shard can score at most, for an item's sorted terms."""
        at = np.searchsorted(self.terms, terms)
        here = at < len(self.terms)
        here[here] = self.terms[at[here]] == terms[here]
        return int((weights[here] * self.highest[at[here]]).sum())

    def scores(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.ids), np.int64)
        for term, weight in zip(terms, weights, strict=True):
            i = np.searchsorted(self.terms, term)
            if i < len(self.terms) and self.terms[i] == term:
                part = slice(self.starts[i], self.ends[i])
                total[self.docs[part]] += weight * self.impacts[part]  # a document is in a list once
        return total


def _best(ids, known, scores, top):
    """Positions of the best, by falling score and then by id; documents without an id come last."""
    if len(scores) > top:
        bar = np.partition(scores, len(scores) - top)[len(scores) - top]
        at = np.flatnonzero(scores >= bar)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], ~known[at], ~scores[at]))[:top]]


def _visit(shards: list[_Shard], items, weights, best: dict, top: int) -> None:
    """Score the items on the shards, each in falling order of bounds; `best` has (ids, known, scores) by item."""
    nothing = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)
    for item, terms in items:
        own = weights[terms]
        bounds = np.array([shard.bound(terms, own) for shard in shards])
        have = best.get(item, nothing)
        for i in np.argsort(-bounds, kind="stable"):
            if bounds[i] == 0 or len(have[2]) == top and bounds[i] < have[2][-1]:
                break
            shard = shards[i]
            scores = shard.scores(terms, own)
            at = np.flatnonzero(scores >= (have[2][-1] if len(have[2]) == top else 1))
            if len(at):
                found = shard.ids[at], shard.known[at], scores[at]
                both = [np.concatenate(pair) for pair in zip(have, found, strict=True)]
                first = _best(*both, top)
                have = tuple(x[first] for x in both)
        if len(have[2]):
            best[item] = have


def _searched(sent, top: int):
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = sent.value
        best: dict = {}
        run, postings = [], 0
        for batch in batches:
            columns = [batch.column(name) for name in ("m", "ids", "known", "terms", "docs", "tfs")]
            for i in range(batch.num_rows):
                m, *lists = (column[i] for column in columns)
                shard = _Shard(m.as_py(), *(x.values.to_numpy(zero_copy_only=False) for x in lists))
                run.append(shard)
                postings += len(shard.docs)
                if postings >= RUN_POSTINGS:
                    _visit(run, items, weights, best, top)
                    run, postings = [], 0
        _visit(run, items, weights, best, top)
        if best:
            sizes = [len(x[2]) for x in best.values()]
            ids, known, scores = (np.concatenate(x) for x in zip(*best.values(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(list(best), sizes)), pa.array(ids, mask=~known), pa.array(scores)], names=["item", "doc_id", "score"]
            )

    return searched


def build_index(counted: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """Shards of the documents in `counted` (doc_id, n, terms, tfs) that hold a numbered term, by their normaliser."""
    m = F.lit(100 - SHARE) + F.expr(f"({SHARE} * n * {n_docs}L) div {n_terms}L")
    rows = counted.where(F.size("terms") > 0).select(m.alias("m"), "doc_id", "terms", "tfs")
    # The number of the row splits a stratum of any size over several tasks; `counted` is stored, so that it stays the same.
    spread = rows.withColumn("at", F.monotonically_increasing_id()).repartitionByRange("m", "at").sortWithinPartitions("m")
    return spread.select("m", "doc_id", "terms", "tfs").mapInArrow(_packed, _SHARD)


def _block(docs: DataFrame, items: DataFrame, top: int) -> DataFrame:
    """The best documents (item, doc_id, score) of a block of items (item, text), whose terms fit into memory."""
    spark = docs.sparkSession
    held = [(row["item"], sorted(count_terms(row["text"].encode()))) for row in items.collect()]
    words = sorted({term for _, terms in held for term in terms})
    numbers = {term: i for i, term in enumerate(words)}
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _counted(spark.sparkContext.broadcast(numbers))("text").alias("c"))
    counted = cut(counted.select("doc_id", "c.*").where("n > 0"))
    n_docs, n_terms = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    weights = np.zeros(len(words), np.int64)
    for row in holding.select("term", weight.alias("weight")).collect():
        weights[row["term"]] = row["weight"]
    if not n_docs:
        return spark.createDataFrame([], _FOUND)
    wanted = [(item, np.array([numbers[t] for t in terms], np.int32)) for item, terms in held]
    sent = spark.sparkContext.broadcast((wanted, weights))
    return build_index(counted, n_docs, n_terms).mapInArrow(_searched(sent, top), _FOUND)


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each row of `items` (item_id, text) the `top` documents of the highest score above 0: item_id, rank (from 1),
    doc_id, score, equal scores by ascending doc_id.

    - A null or empty text has no terms: such a document counts nowhere, such an item finds nothing. Texts are read whole.
    - Each row is a document or an item by itself, whatever its id. A document without an id is returned after all others
      of its score; an item without an id has a null item_id.
    - An empty table of documents or items gives an empty result. Other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = cut(rows.withColumn("item", F.monotonically_increasing_id()))
    n_bytes = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-n_bytes // block_bytes))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    found = [_block(docs, rows.where(block == number).select("item", "text"), top) for number in range(blocks)]
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(rows.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

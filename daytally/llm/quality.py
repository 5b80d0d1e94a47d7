"""Quality by perplexity: an interpolated modified Kneser-Ney model of byte n-grams, trained on trusted text.

Counts of n-grams are summed over the trusted documents, those of shorter ones are the numbers of their distinct
predecessors, and the discounts of each length come from its counts of counts. An n-gram is written as a number that begins
with its context, read backwards, and ends with its last byte, so that sorted n-grams hold those of all shorter lengths
in order. They are dealt into shards by the last two bytes of the context: what the probability of an n-gram takes, from
three bytes up, is in its own shard. Only the numbers of pairs of bytes (65,536 at most) go through the driver.

The documents are stored once, as a table bucketed by block, a block having up to about BLOCK_BYTES of texts. A block asks
each shard once for all its distinct n-grams there, in one packed row; the answers come back to the bucket of its texts,
which stay where they are, and a task adds up the log-probabilities of every document.

A fifth of the trusted documents is kept from training. Quantiles of their perplexity, by language, are the thresholds. As
the mean over few bytes varies more, perplexities are compared after division by exp(SLACK / sqrt(bytes)).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import bounded_batches, cut, runs

ORDER = 6
QUANTILE = 0.99
#: Share of trusted documents that thresholds are taken from: one in this many.
APART = 5
SLACK = 3.0
BROADCAST_IDS = 1_000_000
BLOCK_BYTES = 16 << 20
#: A power of two, at most 256.
SHARDS = 256
#: So many distinct n-grams are counted before they are sent on.
HELD = 4_000_000
_BYTE = 255
_COUNTED = "shard int, n int, keys binary, counts binary"
_ASKED = "block long, shard int, n int, keys binary"
_ANSWERED = "block long, shard int, n int, keys binary, logs binary"
_STORED = "block long, doc_id long, lang string, text string"
_SCORED = "doc_id long, lang string, n_bytes long, perplexity double"
_COUNTED_ARROW = pa.schema([("shard", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_ASKED_ARROW = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("n", pa.int32()), ("keys", pa.binary())])
_ANSWERED_ARROW = _ASKED_ARROW.append(pa.field("logs", pa.binary()))
_SCORED_ARROW = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("n_bytes", pa.int64()), ("perplexity", pa.float64())])


def _keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte, as a number, and where each text's begin; texts are preceded by zero bytes."""
    pad = b"\0" * (ORDER - 1)
    data = np.frombuffer(b"".join(pad + t for t in texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    n = max(len(data) - ORDER + 1, 0)
    keys = np.zeros(n, np.int64)
    for k in [*range(ORDER - 2, -1, -1), ORDER - 1]:
        keys <<= 8
        keys |= data[k : k + n]
    # Windows that reach into the next text's padding are no n-grams of either.
    own = np.ones(n, bool)
    for size, start in zip(sizes.tolist()[:-1], (starts + np.arange(len(texts)) * (ORDER - 1)).tolist(), strict=False):
        own[start + size : start + size + ORDER - 1] = False
    return keys[own], np.append(starts, sizes.sum())


def _turned(grams: np.ndarray) -> np.ndarray:
    """From n-grams in reading order, first byte highest, to keys; and back."""
    out = np.zeros_like(grams)
    for k in range(1, ORDER):
        out = out << 8 | grams >> 8 * k & _BYTE
    return out << 8 | grams & _BYTE


def _shards(keys: np.ndarray) -> np.ndarray:
    pairs = (keys >> 8 * (ORDER - 2)).astype(np.uint64)
    return ((pairs * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)) % np.uint64(SHARDS)).astype(np.uint8)


def _by_shard(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """From sorted keys: each shard that has any, and where they are, sorted."""
    shards = _shards(keys)
    order = np.argsort(shards, kind="stable")
    bounds = np.searchsorted(shards[order], np.arange(SHARDS + 1))
    yield from ((s, order[a:b]) for s, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if a < b)


def _packed(values: np.ndarray) -> bytes:
    """Compressed, all first bytes before all second ones, since neighbours have most of their bytes in common."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def _unpacked(data: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.Codec("zstd").decompress(data, n * size, asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


class _Counts:
    """Distinct n-grams and how often each has come."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > HELD:
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in self.parts] or [np.zeros(0, np.int64)])
        counts = np.concatenate([c for _, c in self.parts] or [np.zeros(0, np.int64)])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        if len(keys):
            keys, counts = keys[first], np.add.reduceat(counts, first)
        self.parts, self.waiting = [(keys, counts)], 0
        return keys, counts


def _bytes(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-grams of a partition with their counts, by shard."""
    held = _Counts()

    def rows() -> Iterator[pa.RecordBatch]:
        keys, counts = held.merged()
        for shard, at in _by_shard(keys):
            row = {"shard": shard, "n": len(at), "keys": _packed(keys[at]), "counts": _packed(counts[at])}
            yield pa.RecordBatch.from_pylist([row], _COUNTED_ARROW)

    for batch in batches:
        for run in runs(batch.column("text")):
            found = pa.array(_keys(_bytes(run))[0]).value_counts()
            held.add(found.field("values").to_numpy(), found.field("counts").to_numpy())
        if len(held.parts[0][0] if held.parts else []) > HELD:
            yield from rows()
            held = _Counts()
    yield from rows()


def _merge(counted: pa.Table) -> pa.Table:
    """All counts of a shard, in one row."""
    held = _Counts()
    for batch in counted.to_batches():
        for row in batch.to_pylist():
            held.add(_unpacked(row["keys"], row["n"], np.int64), _unpacked(row["counts"], row["n"], np.int64))
    keys, counts = held.merged()
    row = {"shard": counted.column("shard")[0].as_py(), "n": len(keys), "keys": _packed(keys), "counts": _packed(counts)}
    return pa.Table.from_pylist([row], _COUNTED_ARROW)


def _levels(keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, n-grams and counts, from ORDER down to two bytes; those of two bytes are the shard's share only."""
    for size in range(ORDER, 1, -1):
        yield size, keys, counts
        # Without the first byte of the context; counted are the distinct bytes that stood there.
        keys, counts = np.unique(keys >> 16 << 8 | keys & _BYTE, return_counts=True)


def _count_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of size, what and n: of three bytes and more, how many n-grams have count 1 to 4; of two, each one's count."""
    for batch in batches:
        for row in batch.to_pylist():
            for size, grams, counts in _levels(*(_unpacked(row[c], row["n"], np.int64) for c in ("keys", "counts"))):
                if size > 2:
                    grams, counts = np.arange(1, 5), np.array([np.count_nonzero(counts == k) for k in range(1, 5)])
                columns = [pa.array(np.full(len(grams), size, np.int32)), pa.array(grams), pa.array(counts)]
                yield pa.RecordBatch.from_arrays(columns, ["size", "what", "n"])


def _discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """The discounts of the counts 0, 1, 2 and more, by the modified Kneser-Ney formulas."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    # Where a count of counts is missing, the formula has no value; 0.75 is the usual choice.
    by = [k - (k + 1) * y * above / at if at and above else 0.75 for k, at, above in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.array([0.0] + [min(max(d, 0.05), float(k)) for k, d in enumerate(by, 1)])


def _mixed(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Probabilities from a row of counts for each context, and those of the shorter n-grams."""
    cuts = _discounts(*(np.count_nonzero(counts == k) for k in range(1, 5)))[np.minimum(counts, 3)]
    total, left_over = counts.sum(1, keepdims=True), cuts.sum(1, keepdims=True)
    return np.where(total > 0, (counts - cuts + left_over * shorter) / np.maximum(total, 1), shorter)


class _Shard:
    """For each length the n-grams of a shard with their discounted counts, the contexts with their totals."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, discounts: dict[int, np.ndarray], pairs: np.ndarray) -> None:
        self.pairs, self.levels = pairs, []
        for size, grams, n in _levels(keys, counts) if len(keys) else ():
            if size > 2:
                cuts = discounts[size][np.minimum(n, 3)]
                first = np.flatnonzero(np.diff(grams >> 8, prepend=-1))
                sums = np.add.reduceat(n, first), np.add.reduceat(cuts, first)
                self.levels.insert(0, (size, grams, n - cuts, grams[first] >> 8, *sums))

    def probabilities(self, keys: np.ndarray) -> np.ndarray:
        """The probability of the last byte of each n-gram after the others."""
        p = self.pairs[keys >> 8 * (ORDER - 1), keys & _BYTE]
        for size, grams, kept, contexts, total, left_over in self.levels:
            context = keys >> 8 * (ORDER - size + 1)
            at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            known = contexts[at] == context
            asked = context << 8 | keys & _BYTE
            of = np.minimum(np.searchsorted(grams, asked), len(grams) - 1)
            seen = np.where(grams[of] == asked, kept[of], 0.0)
            p = np.where(known, (seen + left_over[at] * p) / total[at], p)
        return p


def _partitions(df: DataFrame, most: int = 100_000) -> int:
    """The tasks of a shuffle, or buckets: as the session says, within the bound that Spark sets to buckets."""
    return min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), most)


class Model:
    """The n-grams of all trusted texts with their counts, a row for each shard, and what all shards have in common."""

    def __init__(self, trusted: DataFrame) -> None:
        counted = trusted.select("text").mapInArrow(_count, _COUNTED).repartition(_partitions(trusted), "shard")
        self.counts = cut(counted.groupBy("shard").applyInArrow(_merge, _COUNTED))
        sums = self.counts.mapInArrow(_count_counts, "size int, what long, n long").groupBy("size", "what").agg(F.sum("n").alias("n"))
        common = {(r.size, r.what): r.n for r in sums.collect()}
        self.discounts = {size: _discounts(*(common.get((size, k), 0) for k in range(1, 5))) for size in range(3, ORDER + 1)}
        pairs = np.zeros((256, 256), np.int64)
        for (size, what), n in common.items():
            if size == 2:
                pairs[what >> 8, what & _BYTE] = n
        singles = _mixed(np.count_nonzero(pairs, axis=0)[None, :], np.full((1, 256), 1 / 256))
        self.pairs = _mixed(pairs, singles)

    def answered(self, asked: DataFrame, schema: str, row: Callable[[dict, np.ndarray, np.ndarray], pa.RecordBatch]) -> DataFrame:
        """From rows of `asked` (block, shard, n, keys): what `row` makes of each, its keys and their probabilities."""
        discounts, pairs = self.discounts, self.pairs

        def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Rows of a shard come together, its counts first."""
            none = np.zeros(0, np.int64)
            number, shard = None, None
            for batch in batches:
                for r in batch.to_pylist():
                    keys = _unpacked(r["keys"], r["n"], np.int64)
                    if r["shard"] != number or r["counts"] is not None:
                        own = (none, none) if r["counts"] is None else (keys, _unpacked(r["counts"], r["n"], np.int64))
                        number, shard = r["shard"], _Shard(*own, discounts, pairs)
                    if r["counts"] is None:
                        yield row(r, keys, shard.probabilities(keys))

        rows = self.counts.unionByName(asked, allowMissingColumns=True).repartition(_partitions(asked), "shard")
        return rows.sortWithinPartitions("shard", F.col("counts").isNull()).mapInArrow(answer, schema)

    def probabilities(self, grams: DataFrame) -> DataFrame:
        """From n-grams as numbers, first byte highest: gram and p, the probability of the last byte after the others."""

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield _questions(0, np.sort(_turned(batch.column("gram").to_numpy())))

        def row(_: dict, keys: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(_turned(keys)), pa.array(p)], ["gram", "p"])

        return self.answered(grams.select("gram").mapInArrow(ask, _ASKED), "gram long, p double", row)


def _questions(block: int, keys: np.ndarray) -> pa.RecordBatch:
    rows = [{"block": block, "shard": shard, "n": len(at), "keys": _packed(keys[at])} for shard, at in _by_shard(keys)]
    return pa.RecordBatch.from_pylist(rows, _ASKED_ARROW)


def _ask(texts: pa.Table) -> pa.Table:
    """The distinct n-grams of a block, a row for each shard."""
    held = _Counts()
    for chunk in texts.column("text").chunks:
        for run in runs(chunk):
            found = pa.array(_keys(_bytes(run))[0]).unique().to_numpy()
            held.add(found, np.ones(len(found), np.int64))
    return pa.Table.from_batches([_questions(texts.column("block")[0].as_py(), held.merged()[0])])


def _answer(asked: dict, keys: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
    known = {c: asked[c] for c in ("block", "shard", "n", "keys")}
    return pa.RecordBatch.from_pylist([known | {"logs": _packed(np.log(p).astype(np.float32))}], _ANSWERED_ARROW)


def _score(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """Perplexities of the documents of a block, from the log-probabilities of all its n-grams."""
    rows = answers.to_pylist()
    keys = np.concatenate([_unpacked(r["keys"], r["n"], np.int64) for r in rows] or [np.zeros(0, np.int64)])
    logs = np.concatenate([_unpacked(r["logs"], r["n"], np.float32) for r in rows] or [np.zeros(0, np.float32)])
    order = np.argsort(keys)
    keys, logs = keys[order], logs[order]
    sizes, totals = [np.zeros(0, np.int64)], [np.zeros(0)]
    for chunk in texts.column("text").chunks:
        for run in runs(chunk):
            found, starts = _keys(_bytes(run))
            found = pa.array(found).dictionary_encode()
            asked = found.dictionary.to_numpy()
            at = np.searchsorted(keys, asked)
            if len(asked) and (at.max() == len(keys) or (keys[at] != asked).any()):
                raise RuntimeError("a block lacks the answer for one of its n-grams")
            sums = np.append(0.0, np.cumsum(logs[at][found.indices.to_numpy()], dtype=np.float64))
            sizes.append(np.diff(starts))
            totals.append(sums[starts[1:]] - sums[starts[:-1]])
    n, total = np.concatenate(sizes), np.concatenate(totals)
    perplexity = pa.array(np.exp(-total / np.maximum(n, 1)), mask=n == 0)
    columns = [texts.column("doc_id"), texts.column("lang"), pa.array(n), perplexity]
    return pa.Table.from_arrays(columns, schema=_SCORED_ARROW)


def perplexities(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of `docs` (doc_id, lang, text): doc_id, lang, n_bytes, perplexity; null for an empty text.

    The documents are kept in a table of the warehouse until the result is computed, which is at once.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    # Read once and stored: n-grams and texts of a block belong together, whatever `docs` comes from.
    name = f"quality_{uuid.uuid4().hex}"
    try:
        stored = _blocks(docs).write.option("compression", "zstd").bucketBy(_partitions(docs), "block")
        stored.saveAsTable(name, format="parquet")
        texts = spark.table(name)
        answers = model.answered(texts.groupBy("block").applyInArrow(_ask, _ASKED), _ANSWERED, _answer)
        return cut(texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score, _SCORED))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _blocks(docs: DataFrame) -> DataFrame:
    """The documents with the number of their block."""
    most = BLOCK_BYTES

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = None, 0
        for batch in batches:
            at = 0
            for run in runs(batch.column("text")):
                here = batch.slice(at, len(run))
                at += len(run)
                if block is None or size >= most:
                    block, size = here.column("number")[0].as_py(), 0  # of the block's first row, so no other block has it
                size += sum(pa.compute.fill_null(pa.compute.binary_length(run), 0).to_pylist())
                columns = [pa.array(np.full(len(run), block)), *(here.column(c) for c in ("doc_id", "lang", "text"))]
                yield pa.RecordBatch.from_arrays(columns, ["block", "doc_id", "lang", "text"])

    known = [F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string")]
    return docs.select(F.monotonically_increasing_id().alias("number"), *known).mapInArrow(read, _STORED)


def _apart(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(APART)) == 0


def judged(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """One row per row of `docs` (doc_id, lang, text): doc_id, lang, n_bytes, perplexity, threshold, kept.

    Trusted are the documents that `labels` (doc_id, quality) give quality 1 and no other. A document is kept if its
    perplexity, adjusted to its length, is at most the threshold of its language: the quantile of trusted documents that
    the model has not seen.

    - A null or empty text has no perplexity and is not kept; texts of any length are scored whole.
    - A null lang is a language of its own. A language without trusted documents takes the quantile over all of them;
      without any trusted document every text is kept.
    - Rows without a doc_id are scored and never trusted; rows that repeat an id are each scored, and trusted together.
      doc_id is a number, as in `labels`.
    - An empty table gives an empty result. Other columns, whatever their names, are not read.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select("doc_id", "lang", "text")
    trusted = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    trusted = cut(trusted.where("low = 1 and high = 1").select(F.col("doc_id").alias("trusted")))
    known = F.broadcast(trusted) if trusted.count() <= BROADCAST_IDS else trusted
    learned = docs.where(~_apart(F.col("doc_id"))).join(known, F.col("doc_id") == F.col("trusted"), "left_semi")
    scored = perplexities(docs, Model(learned))
    test = scored.where(_apart(F.col("doc_id")) & F.col("perplexity").isNotNull())
    test = test.join(known, F.col("doc_id") == F.col("trusted"), "left_semi")
    adjusted = F.col("perplexity") / F.exp(SLACK / F.sqrt("n_bytes"))
    level = F.percentile_approx(adjusted, quantile, 10_000)
    by_lang = test.groupBy("lang").agg(level.alias("own")).withColumnRenamed("lang", "of")
    overall = test.agg(level.alias("overall")).first().overall
    rows = scored.join(by_lang, F.col("lang").eqNullSafe(F.col("of")), "left")
    threshold = F.coalesce("own", F.lit(overall).cast("double"))
    kept = F.col("perplexity").isNotNull() & F.coalesce(adjusted <= threshold, F.lit(True))
    return rows.select("doc_id", "lang", "n_bytes", "perplexity", threshold.alias("threshold"), kept.alias("kept"))

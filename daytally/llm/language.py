"""Language identification: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

A text is lower-cased, everything in ASCII that is no letter becomes a blank, and the runs of 2 to 4 bytes that hold a
blank at an end at most are hashed into BUCKETS embeddings. Their average goes through a linear layer and a softmax.

The classifier is fitted on the driver to a sample of about SAMPLE_DOCS labelled documents, spread evenly over the
MOST_LANGUAGES most frequent languages, or LEAST_PER_LANGUAGE of each if that is more; what is collected of a document is
its histogram of buckets, which does not grow with the text. A fifth of the sample is kept from training, and calibrates
what is read off the model: the temperature that makes the score a probability, and two limits beyond which a text is
rejected. One is on the score. As a softmax only tells learned languages from each other, the other is on how far the
mean log-probability of the text's subwords, by their shares in the language's training texts, lies below that of the
language itself. Everything else covers all rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm.common import bounded_batches, runs

UNKNOWN = "und"
SAMPLE_DOCS = 1500
LEAST_PER_LANGUAGE = 20
MOST_LANGUAGES = 100
SIZES = (2, 3, 4)
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 16
EPOCHS = 6
RATE = 0.5
BATCH = 32
#: Words of the short training texts that are cut from each sampled document.
SNIPPETS = (1, 2, 4, 12)
#: Share of right texts that calibration may reject, and how much further the limit on subwords goes, as the texts are few.
REJECTED_SHARE = 0.001
MARGIN = 1.25
#: Share of a language's subwords that is spread over all buckets.
UNSEEN = 0.05
_SEGMENT = 1 << 17
_ODD = np.uint64(0x9E3779B97F4A7C15)
_KEPT = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_MAYBE_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _MAYBE_LETTER.finditer(text))


def _bytes(text: str) -> bytes:
    return b" %b " % text.lower().encode("utf-8", "replace").translate(_KEPT)


def _segments(text: bytes) -> Iterator[bytes]:
    """Long texts in parts that begin and end with a blank, if they have blanks at all."""
    at = 0
    while len(text) - at > _SEGMENT:
        blank = text.rfind(b" ", at + 1, at + _SEGMENT)
        end = blank if blank > at else at + _SEGMENT
        yield text[at : end + 1]
        at = end
    yield text[at:]


def _subwords(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and buckets of the subwords of each size."""
    blank = data == 32
    wide = data.astype(np.uint64)
    code = wide.copy()
    inside = np.zeros(len(data), bool)
    for size in range(2, max(SIZES) + 1):
        n = len(data) - size + 1
        if n < 1:
            return
        if size > 2:
            inside = inside[:n] | blank[size - 2 : size - 2 + n]
        code = code[:n] | wide[size - 1 :] << np.uint64(8 * (size - 1))
        if size in SIZES:
            at = np.flatnonzero(~inside[:n] & ~(blank[:n] & blank[size - 1 :]))
            yield at, ((code[at] + np.uint64(size)) * _ODD >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def histogram(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text and their shares."""
    counts = np.zeros(BUCKETS)
    for part in _segments(_bytes(text)):
        for _, buckets in _subwords(np.frombuffer(part, np.uint8)):
            counts += np.bincount(buckets, minlength=BUCKETS)
    met = np.flatnonzero(counts)
    return met, counts[met] / max(counts.sum(), 1)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray
    """What a bucket adds to each language's score, or its embedding where there are more languages than dimensions."""
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    logs: np.ndarray
    """Of each bucket and language, the log of its share, less the language's mean."""
    least_score: float
    most_strange: float

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the best language, its probability, and how strange the subwords are to it, for texts that have letters."""
        parts = [(i, part) for i, text in enumerate(texts) for part in _segments(_bytes(text))]
        of = np.array([i for i, _ in parts])
        starts = np.cumsum([0] + [len(p) for _, p in parts])
        sums, counts = np.zeros((len(texts), self.table.shape[1])), np.zeros(len(texts))
        held = []
        for at, buckets in _subwords(np.frombuffer(b"".join(p for _, p in parts), np.uint8)):
            bounds = np.searchsorted(at, starts)
            here = np.flatnonzero(np.diff(bounds))
            np.add.at(counts, of, np.diff(bounds))
            for k in range(self.table.shape[1]):
                np.add.at(sums[:, k], of[here], np.add.reduceat(self.table[:, k][buckets], bounds[here]))
            held.append((buckets, bounds, here))
        scores = sums / np.maximum(counts, 1)[:, None] @ self.weights + self.bias
        shares = _softmax(scores / self.temperature)
        best = shares.argmax(axis=1)
        logs, n = np.zeros(len(texts)), self.logs.shape[1]
        for buckets, bounds, here in held:
            if len(here):
                column = np.repeat(best[of], np.diff(bounds))
                np.add.at(logs, of[here], np.add.reduceat(self.logs.ravel()[buckets * n + column], bounds[here]))
        return best, shares[np.arange(len(texts)), best], -logs / np.maximum(counts, 1)

    def told(self, score, strange):
        """Whether a language is told: numbers, arrays or columns."""
        return (score >= self.least_score) & (strange <= self.most_strange)


def _softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


class _Rows:
    """Histograms in compressed rows."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.starts = np.cumsum([0] + [len(b) for b, _ in rows])
        self.buckets = np.concatenate([b for b, _ in rows])
        self.shares = np.concatenate([s for _, s in rows])

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = self.starts[rows + 1] - self.starts[rows]
        begins = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) - np.repeat(begins - self.starts[rows], sizes)
        return self.buckets[at], self.shares[at], begins


def _logs(rows: _Rows, right: np.ndarray, learn: np.ndarray, n: int) -> np.ndarray:
    """Log shares of the buckets in the whole texts of each language, less their mean over its texts."""
    logs = np.zeros((BUCKETS, n), np.float32)
    for k in range(n):
        own = learn[right[learn] == k]
        share = np.zeros(BUCKETS)
        if len(own):
            buckets, shares, _ = rows.take(own)
            np.add.at(share, buckets, shares)
            share /= share.sum()
        log = np.log((1 - UNSEEN) * share + UNSEEN / BUCKETS)
        logs[:, k] = log - share @ log
    return logs


def train(histograms: list, labels: list[str], whole: list[bool], apart: list[bool], seed: int = 7) -> Model:
    """Fit to rows that are not `apart`; temperature and limits come from those that are, or all if there are none."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((BUCKETS, 1)), np.zeros((1, 1)), np.zeros(1), 1.0, np.zeros((BUCKETS, 1)), 0.0, np.inf)
    rows, right = _Rows(histograms), np.array([languages.index(x) for x in labels])
    whole, apart = np.array(whole), np.array(apart)
    if apart.all() or not apart.any():
        learn = check = np.arange(len(labels))
    else:
        learn, check = np.flatnonzero(~apart), np.flatnonzero(apart)
    rng = np.random.default_rng(seed)
    embeddings = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights, bias = rng.normal(0, 0.1, (DIMENSIONS, len(languages))), np.zeros(len(languages))

    def forward(batch):
        buckets, shares, begins = rows.take(batch)
        mean = np.add.reduceat(embeddings[buckets] * shares[:, None], begins, axis=0)
        return buckets, shares, begins, mean, mean @ weights + bias

    # Every language counts the same, however many documents it has.
    share = len(learn) / (len(languages) * np.maximum(np.bincount(right[learn], minlength=len(languages)), 1))
    for epoch in range(EPOCHS):
        order = rng.permutation(learn)
        rate = RATE * (1 - epoch / EPOCHS)
        for k in range(0, len(order), BATCH):
            batch = order[k : k + BATCH]
            buckets, shares, begins, mean, scores = forward(batch)
            slope = _softmax(scores)
            slope[np.arange(len(batch)), right[batch]] -= 1
            slope *= share[right[batch]][:, None] / len(batch)
            back = slope @ weights.T
            weights -= rate * 10 * (mean.T @ slope)
            bias -= rate * slope.sum(axis=0)
            sizes = np.diff(np.append(begins, len(buckets)))
            # The mean of many buckets moves each of them little, so their rate is higher.
            np.subtract.at(embeddings, buckets, 100 * rate * shares[:, None] * np.repeat(back, sizes, axis=0))
    scores = np.concatenate([forward(check[k : k + 64])[-1] for k in range(0, len(check), 64)])
    temperature = min(
        np.geomspace(0.05, 20, 121), key=lambda t: -np.log(_softmax(scores / t)[np.arange(len(check)), right[check]] + 1e-12).mean()
    )
    shares = _softmax(scores / temperature)
    logs = _logs(rows, right, learn[whole[learn]] if whole[learn].any() else learn, len(languages))
    strange = np.concatenate([_strange(rows, logs, check[k : k + 64], right) for k in range(0, len(check), 64)])
    fine = shares.argmax(axis=1) == right[check]
    limits = (0.0, np.inf)
    if fine.any():
        limits = (
            float(np.quantile(shares.max(axis=1)[fine], REJECTED_SHARE)),
            MARGIN * max(0.0, float(np.quantile(strange[fine], 1 - REJECTED_SHARE))),
        )
    if len(languages) <= DIMENSIONS:
        return Model(languages, embeddings @ weights, np.eye(len(languages)), bias, float(temperature), logs, *limits)
    return Model(languages, embeddings, weights, bias, float(temperature), logs, *limits)


def _strange(rows: _Rows, logs: np.ndarray, batch: np.ndarray, right: np.ndarray) -> np.ndarray:
    buckets, shares, begins = rows.take(batch)
    own = np.repeat(right[batch], np.diff(np.append(begins, len(buckets))))
    return -np.add.reduceat(logs[buckets, own] * shares, begins)


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from; a document without an id is not among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


# Buckets and shares as the bytes of int32 and float32 arrays, as lists would be many times larger on the driver.
_HISTOGRAMS = T.ArrayType(
    T.StructType([T.StructField("buckets", T.BinaryType()), T.StructField("shares", T.BinaryType())])
)
_HISTOGRAMS_ARROW = pa.list_(pa.struct([("buckets", pa.binary()), ("shares", pa.binary())]))


@F.arrow_udf(_HISTOGRAMS)
def _examples(texts: pa.Array) -> pa.Array:
    """Histograms of the text and of short parts of it."""
    out = []
    for text in texts.to_pylist():
        words, rows = text.split(), [histogram(text)]
        for i, size in enumerate(SNIPPETS):
            at = (len(words) * (2 * i + 1)) // (2 * len(SNIPPETS))
            part = " ".join(words[at : at + size])
            if has_letter(part):
                rows.append(histogram(part))
        out.append([{"buckets": b.astype("<i4").tobytes(), "shares": s.astype("<f4").tobytes()} for b, s in rows])
    return pa.array(out, _HISTOGRAMS_ARROW)


@F.arrow_udf(T.BooleanType())
def _lettered(texts: pa.Array) -> pa.Array:
    return pa.array([t is not None and has_letter(t) for t in texts.to_pylist()], pa.bool_())


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn from text and lang of a bounded sample of the rows of `docs` that have a doc_id, lang and letters."""
    bounded_batches(docs.sparkSession)
    docs = docs.select("doc_id", "lang", "text").where("doc_id is not null and lang is not null and text is not null")
    counts = docs.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES)
    counts = {r.lang: r.n for r in counts.collect()}
    each = max(LEAST_PER_LANGUAGE, sample_docs // max(len(counts), 1))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    if not counts:
        return train([], [], [], [])
    part = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, each / n))])
    sample = docs.where(place < part[F.col("lang")]).where(_lettered("text"))
    rows = sample.select(F.xxhash64("doc_id").alias("h"), "lang", _examples("text").alias("examples")).collect()
    rows.sort(key=lambda r: (r.h, r.lang))
    histograms, labels, whole, apart = [], [], [], []
    for row in rows:
        for i, example in enumerate(row.examples):
            histograms.append((np.frombuffer(example.buckets, "<i4"), np.frombuffer(example.shares, "<f4")))
            labels.append(row.lang)
            whole.append(i == 0)
            apart.append(row.h % 5 == 0)
    return train(histograms, labels, whole, apart)


_GUESS = T.StructType(
    [T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("strange", T.DoubleType())]
)


def guess(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct column with the best language, its probability, and how strange the text is to it; `und`, 0 and 0 where no
    text has letters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bounded_batches(docs.sparkSession)

    @F.arrow_udf(_GUESS)
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for texts in batches:
            langs, scores, strange = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            row = 0
            for run in runs(texts, _SEGMENT):
                here = [(row + i, t) for i, t in enumerate(run.to_pylist()) if t is not None and has_letter(t)]
                row += len(run)
                if here and model.languages:
                    for (i, _), k, score, far in zip(here, *model.predict([t for _, t in here]), strict=True):
                        langs[i], scores[i], strange[i] = model.languages[k], float(score), float(far)
            columns = pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(strange, pa.float64())
            yield pa.StructArray.from_arrays(columns, _GUESS.names)

    return predicted(F.col(text))


def predict_languages(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row per row of `docs` (doc_id, text, lang): doc_id, held_out, lang_pred, score, rejected.

    Learned from rows that are not held out. A rejected text has no letter, or a score or subwords beyond the calibrated
    limits: its language is not among the learned ones, or it is no language.

    - A null text or one without a letter is `und` with score 0; texts of any length are read whole.
    - Rows without a doc_id or lang are not learned from; without any labelled row everything is `und`.
    - Rows are judged one by one: ids may repeat. An empty table gives an empty result.
    - Other columns, whatever their names, are not read.
    """
    model = fit(docs.where(~held_out(F.col("doc_id"))), sample_docs)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), guess(docs, model).alias("g")).select(
        "doc_id",
        "held_out",
        F.col("g.lang").alias("lang_pred"),
        "g.score",
        ((F.col("g.lang") == UNKNOWN) | ~model.told(F.col("g.score"), F.col("g.strange"))).alias("rejected"),
    )


def without_rejected(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The rows of `docs` whose language is told, with all their columns as they were."""
    model = fit(docs.where(~held_out(F.col("doc_id"))), sample_docs)
    judged = docs.withColumn("_guess", guess(docs, model))
    told = (F.col("_guess.lang") != UNKNOWN) & model.told(F.col("_guess.score"), F.col("_guess.strange"))
    return judged.where(told).drop("_guess")

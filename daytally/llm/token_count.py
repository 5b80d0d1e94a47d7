"""Count tokens as a public tokenizer gives them, returning lengths only.

Texts are cut where no token can cross: at a blank between two characters that are no white space. The pre-tokenizer of
the vocabulary always begins a new word there, and no special string holds a blank. Each fragment is given to the
library as it is, in batches of about BATCH_BYTES; the counts of short fragments are remembered, as most of them come
back. So a long text needs no more memory than a short one, and a special string inside a text is handled as the
library does by default.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm.common import bounded_batches, runs

LIMIT = 512
# Fragments that a worker remembers at most, and the longest of them; others are counted anew each time.
REMEMBERED = 600_000
SHORT = 48
BATCH_BYTES = 1 << 20
_SAFE = re.compile(r"(?<=\S)(?= \S)")


class FragmentCounter:
    """Token counts of texts by the tokenizers library; `path` names a file whose words begin at blanks."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # Without the blank that stands before each.
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        cuts = [t.split(" ") for t in texts]
        inner = [c[1:-1] for c in cuts]
        unknown = set().union(*inner).difference(known)
        # Next to white space a blank is no safe place; texts with such a piece are cut by the pattern instead.
        unsafe = {p for p in unknown if not p or p[0].isspace() or p[-1].isspace()}
        fresh = list(unknown - unsafe)
        known.update(zip(fresh, self._encoded([" " + p for p in fresh]), strict=True))
        counts, ends = [], []
        for text, cut, middle in zip(texts, cuts, inner, strict=True):
            first, last = cut[0], cut[-1]
            plain = first and not first[-1].isspace() and (len(cut) == 1 or (last and not last[0].isspace()))
            if plain and unsafe.isdisjoint(middle):
                counts.append(sum(map(known.__getitem__, middle)))
                ends.append([first, " " + last] if len(cut) > 1 else [first])
            else:
                fragments = _SAFE.split(text)
                met = [known.get(f[1:]) if f[0] == " " else None for f in fragments] if text else []
                counts.append(sum(filter(None, met)))
                ends.append([f for f, n in zip(fragments, met, strict=False) if n is None])
        rest = iter(self._encoded([f for e in ends for f in e]))
        counts = [n + sum(next(rest) for _ in e) for n, e in zip(counts, ends, strict=True)]
        for piece in [p for p in fresh if len(p) > SHORT]:
            del known[piece]
        return counts

    def _encoded(self, fragments: list[str]) -> list[int]:
        out, start, held = [], 0, 0
        for i, fragment in enumerate(fragments):
            if i > start and held + len(fragment) > BATCH_BYTES:
                out += self._lengths(fragments[start:i])
                start, held = i, 0
            held += len(fragment)
        return out + self._lengths(fragments[start:])

    def _lengths(self, fragments: list[str]) -> list[int]:
        return list(map(len, self.tokenizer.encode_batch_fast(fragments, add_special_tokens=False)))


def _counter_udf(path: str):
    @F.arrow_udf(T.LongType())
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = FragmentCounter(path)
        for texts in batches:
            counts = [n for run in runs(texts, BATCH_BYTES) for n in counter.count([t or "" for t in run.to_pylist()])]
            yield pa.array(counts, pa.int64())

    return n_tokens


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit.

    `path` names the vocabulary file on every executor, of a byte-level tokenizer whose words begin at blanks.

    - A null or empty text has no bytes and no tokens; texts of any length are counted whole.
    - Rows are counted one by one: ids may be null or repeat. An empty table gives an empty result.
    - Other columns, whatever their names, are not read.
    """
    bounded_batches(docs.sparkSession)
    counted = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        _counter_udf(path)(F.col("text")).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

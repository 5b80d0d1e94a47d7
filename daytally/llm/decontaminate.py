"""Find passages of a benchmark in documents by Wu-Manber multi-pattern search.

The patterns are windows of ten consecutive words of an item, written as lower-case words between single blanks, and are
searched for in documents written likewise. A window of bytes moves over the text and its last block of bytes is looked
up: the shift table says how far the window may move without missing a pattern; where it may not move, the hash of the
block and of the window's first bytes selects a few patterns, and these are compared byte by byte. The text is cut into
overlapping stretches whose windows move in step, one array operation moving all of them.

The benchmark is a stated query set. Its distinct windows are numbered and broadcast in blocks of at most about
`block_bytes` bytes; a larger benchmark takes one pass over the documents per block, cut by a checkpoint. Which items a
window stands in is a table: a line that many items share is sent once, and numbers found are joined with their items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm.common import bounded_batches, cut, runs

WINDOW_WORDS = 10
BLOCK_BYTES = 8 << 20
_STRETCH = 1024
# A-Z lower-cased; all bytes that are no part of a word become blanks.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD_BYTES).split()


def windows(item: list[bytes], size: int = WINDOW_WORDS) -> list[bytes]:
    """All runs of `size` words, or the whole item if it has fewer; none for an item without words."""
    return [b" %b " % b" ".join(item[i : i + size]) for i in range(max(len(item) - size, 0) + 1)] if item else []


class _Searcher:
    """Wu-Manber tables of patterns of similar length."""

    def __init__(self, patterns: list[bytes]) -> None:
        self.patterns = patterns
        self.least = min(map(len, patterns))
        self.block = min(8, self.least)
        self.mask = np.uint64((1 << 8 * self.block) - 1)
        per_pattern = self.least - self.block + 1
        bits = min(22, max(12, int(np.ceil(np.log2(len(patterns) * per_pattern))) + 3))
        self.down = np.uint64(64 - bits)
        heads = np.frombuffer(b"".join(p[: self.least] for p in patterns), np.uint8).reshape(-1, self.least)
        padded = np.zeros((len(patterns), self.least + 8), np.uint8)
        padded[:, : self.least] = heads
        self.shift = np.full(1 << bits, per_pattern, np.int64)
        for at in range(per_pattern):
            code = np.ascontiguousarray(padded[:, at : at + 8]).view("<u8").ravel() & self.mask
            np.minimum.at(self.shift, (code * _SPREAD) >> self.down, per_pattern - 1 - at)
        first = np.ascontiguousarray(padded[:, :8]).view("<u8").ravel() & self.mask
        keys = code * _SPREAD ^ first * _OTHER
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def find(self, text: bytes) -> Iterator[tuple[int, int]]:
        """Start and pattern number of all occurrences; `text` must end in eight bytes that no pattern has."""
        n, least, block = len(text) - 8, self.least, self.block
        codes = np.ndarray((n,), "<u8", text, strides=(1,))
        # Positions are those of a window's last block.
        at = np.arange(least - block, n - block + 1, _STRETCH)
        end = np.minimum(at + _STRETCH, n - block + 1)
        found = []
        while at.size:
            shift = self.shift[((codes[at] & self.mask) * _SPREAD) >> self.down]
            stops = shift == 0
            if stops.any():
                found.append(at[stops])
            at = at + np.maximum(shift, 1)
            on = at < end
            if not on.all():
                at, end = at[on], end[on]
        if not found:
            return
        at = np.sort(np.concatenate(found))
        start = at - (least - block)
        keys = (codes[at] & self.mask) * _SPREAD ^ (codes[start] & self.mask) * _OTHER
        low, high = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, "right")
        for i in np.flatnonzero(low < high):
            where = int(start[i])
            for number in self.order[low[i] : high[i]]:
                if text.startswith(self.patterns[number], where):
                    yield where, int(number)


class Searcher:
    """Patterns by length, so that a short item doesn't shorten the shifts of long ones."""

    _LENGTHS = (8, 24, 48)

    def __init__(self, numbers: dict[bytes, int]) -> None:
        by_length: dict[int, list[bytes]] = {}
        for pattern in sorted(numbers):
            by_length.setdefault(sum(len(pattern) >= n for n in self._LENGTHS), []).append(pattern)
        self.parts = [_Searcher(patterns) for patterns in by_length.values()]
        self.numbers = numbers

    def search(self, docs: list[list[bytes]]) -> Iterator[tuple[int, int, int, int]]:
        """Document number, first word, word after the last, window number of every occurrence."""
        texts = [b" %b \n" % b" ".join(doc) for doc in docs]
        ends = np.cumsum([len(t) for t in texts])
        joined = b"".join(texts) + b"\n" * 8
        blanks: dict[int, np.ndarray] = {}
        for part in self.parts:
            for at, number in part.find(joined):
                doc = int(np.searchsorted(ends, at, "right"))
                begin = int(ends[doc]) - len(texts[doc])
                if doc not in blanks:
                    blanks[doc] = np.flatnonzero(np.frombuffer(texts[doc], np.uint8) == 32)
                first = int(np.searchsorted(blanks[doc], at - begin))
                pattern = part.patterns[number]
                yield doc, first, first + pattern.count(b" ") - 1, self.numbers[pattern]


_FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("windows", T.ArrayType(T.LongType())),
    ]
)
_FOUND_ARROW = pa.struct(
    [("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int32()))), ("windows", pa.list_(pa.int64()))]
)


def _search_udf(tables):
    """`tables`: the broadcast patterns of one block."""

    @F.arrow_udf(_FOUND)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        searcher = Searcher(tables.value)
        for texts in batches:
            out = []
            for run in runs(texts):
                docs = [words(t) for t in run.cast(pa.binary()).to_pylist()]
                spans, met = [set() for _ in docs], [set() for _ in docs]
                for doc, first, end, number in searcher.search(docs):
                    spans[doc].add((first, end))
                    met[doc].add(number)
                out += [
                    {"n_words": len(d), "spans": _joined(s), "windows": sorted(m)}
                    for d, s, m in zip(docs, spans, met, strict=True)
                ]
            yield pa.array(out, _FOUND_ARROW)

    return search


def _joined(spans: set[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


def numbered_windows(benchmark: DataFrame, size: int = WINDOW_WORDS) -> tuple[DataFrame, DataFrame]:
    """The distinct windows (number, pattern), and the items that each stands in (number, item)."""

    @F.arrow_udf(T.ArrayType(T.BinaryType()))
    def item_windows(texts: pa.Array) -> pa.Array:
        return pa.array([windows(words(t), size) for t in texts.cast(pa.binary()).to_pylist()], pa.list_(pa.binary()))

    item = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")
    rows = cut(benchmark.select(item, F.explode(item_windows(F.col("text"))).alias("pattern")).distinct())
    numbered = cut(rows.select("pattern").distinct().select(F.monotonically_increasing_id().alias("number"), "pattern"))
    return numbered, rows.join(numbered, "pattern").select("number", "item")


def _blocks(numbered: DataFrame, block_bytes: int) -> Iterator[dict[bytes, int]]:
    """Windows and their numbers, in blocks of a bounded size: each window is in one block, once."""
    total = numbered.agg(F.sum(F.length("pattern") + 16)).first()[0] or 0
    n = -(-total // block_bytes)
    for k in range(n):
        rows = numbered.where(F.pmod(F.xxhash64("pattern"), F.lit(n)) == k).collect()
        if rows:
            yield {bytes(row.pattern): row.number for row in rows}


def with_leaks(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES, name: str = "leaks"
) -> DataFrame:
    """Add column `name`, a struct of n_words, spans (word ranges that occurrences cover) and windows (numbers of those met).

    - A null or empty text has no words and no leaks; texts of any length are searched as a whole.
    - An item without words is in no document; an item of fewer than `size` words is searched for as a whole.
    - Empty tables give no leaks or no rows. All other columns pass through; one called `name` is replaced.
    """
    return _searched(docs, numbered_windows(benchmark, size)[0], block_bytes, name)


def _searched(docs: DataFrame, numbered: DataFrame, block_bytes: int, name: str) -> DataFrame:
    spark = docs.sparkSession
    bounded_batches(spark)
    found = None
    for numbers in _blocks(numbered, block_bytes):
        here = _search_udf(spark.sparkContext.broadcast(numbers))(F.col("text"))
        if found is None:
            docs, found = docs.withColumn(name, here), True
            continue
        both = docs.withColumn("_here", here)
        merged = F.struct(
            F.col("_here.n_words").alias("n_words"),
            F.concat(f"{name}.spans", "_here.spans").alias("spans"),
            F.concat(f"{name}.windows", "_here.windows").alias("windows"),
        )
        docs = cut(both.withColumn(name, merged).drop("_here"))
    if found is None:
        docs = docs.withColumn(name, _search_udf(spark.sparkContext.broadcast({}))(F.col("text")))
    return docs


def n_hit(spans: Column) -> Column:
    """Words in any of the ranges, which may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def add(held: Column, span: Column) -> Column:
        new = F.greatest(F.lit(0), span[1] - F.greatest(span[0], held["end"]))
        return F.struct((held["n"] + new).alias("n"), F.greatest(held["end"], span[1]).alias("end"))

    return F.aggregate(F.array_sort(spans), start, add)["n"]


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (see `with_leaks`).

    Items that repeat an id are one item. Items without an id are one too, with the id ''.
    """
    numbered, items = numbered_windows(benchmark, size)
    leaks = _searched(docs.select("doc_id", "text"), numbered, block_bytes, "leaks")
    leaks = cut(
        leaks.select("doc_id", "leaks.n_words", n_hit(F.col("leaks.spans")).alias("n_hit"), F.col("leaks.windows").alias("met"))
    )
    # Documents that have met the same windows have the same items.
    kinds = leaks.where("n_hit > 0").select("met").distinct()
    ids = kinds.select("met", F.explode("met").alias("number")).join(items, "number").groupBy("met")
    ids = ids.agg(F.array_sort(F.collect_set("item")).alias("ids")).select(F.col("met").alias("of"), "ids")
    # Documents without a hit are most of all, and would be one key.
    hit = leaks.where("n_hit > 0").join(ids, F.col("met") == F.col("of"))
    clean = leaks.where("n_hit = 0").withColumn("ids", F.array().cast("array<string>"))
    columns = ["doc_id", "n_words", "n_hit", "ids"]
    return hit.select(columns).unionAll(clean.select(columns)).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of `docs` that hold no window of the benchmark, with all their columns."""
    return with_leaks(docs, benchmark, name="_leaks", **how).where(F.size("_leaks.spans") == 0).drop("_leaks")

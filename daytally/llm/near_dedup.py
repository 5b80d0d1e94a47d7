"""Near-duplicates by MinHash: one permutation with optimal densification, banded buckets and star-shaped candidates.

A document's shingles are hashed once. The top bits of a hash name one of BINS bins, the smallest hash of a bin is its
value, and an empty bin borrows the value of another, chosen by a hash of the bin's number that does not depend on the
document. Bands of ROWS values are bucket keys. With 32 bands of 4, two documents of similarity 0.75 share no bucket
with a probability of 0.684 ** 32, or 5 in a million.

Documents with equal sets are one class and take part once. Within a bucket every member is a candidate with the
bucket's first member only, so a bucket of n gives n - 1 candidates. As a star can miss a pair whose bucket has a foreign
centre, buckets that still hold several components get a second pass: small ones give all their pairs, larger ones further
stars, whose centres are first in the orders of two hashes. Members of larger buckets that are mixed even then go through a
prefix-filter join of their full sets (`_pairs`), which is exact.
Candidates whose signatures agree in less than half of their values are no links: of documents of similarity 0.75, one
pair in ten billion. All others are confirmed on the full sets, which are made anew from the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm.common import bounded_batches, cut, runs
from daytally.llm.components import components
from daytally.llm.shingles import SHINGLE_WORDS, mix, shingle_sets, similar

BIN_BITS = 7
BINS = 1 << BIN_BITS
ROWS = 4
BANDS = BINS // ROWS
PERCENT = 75
#: Further centres of each large mixed bucket, in as many orders of its members.
ORDERS = 2
#: Buckets of so many members give all pairs of members that stars have not connected.
SMALL_BUCKET = 16
#: A shingle of more sets than this is common in the prefix-filter join, and the step of this bound from level to level.
COMMON = 64
COMMON_STEP = 8
#: Of BINS values two documents of similarity 0.75 agree in 96 +- 5; below this they are no candidates.
LEAST_AGREEING = BINS // 2
#: Ids of eight bytes that may be broadcast.
BROADCAST_IDS = 500_000
#: Groups of the prefix-filter join, of about 150 bytes, that may be broadcast.
BROADCAST_GROUPS = 50_000
_BIN_STARTS = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BIN_BITS)
_ROW_WEIGHTS = mix(np.arange(BINS, dtype=np.uint64) + np.uint64(7)) | np.uint64(1)


def bin_values(hashes: np.ndarray) -> np.ndarray:
    """The densified signature of a sorted set that is not empty."""
    at = np.minimum(np.searchsorted(hashes, _BIN_STARTS), len(hashes) - 1)
    values = hashes[at]
    full = values >> np.uint64(64 - BIN_BITS) == np.arange(BINS, dtype=np.uint64)
    empty = np.flatnonzero(~full)
    tries = 0
    while empty.size:
        tries += 1
        lender = (mix(empty.astype(np.uint64) + np.uint64(tries << BIN_BITS)) >> np.uint64(20)) % np.uint64(BINS)
        ready = full[lender]
        values[empty[ready]] = values[lender[ready]]
        empty = empty[~ready]
    return values


def band_keys(values: np.ndarray) -> np.ndarray:
    return mix((values * _ROW_WEIGHTS).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64)).view(np.int64)


_SKETCH = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("signature", T.BinaryType()),
    ]
)


@F.arrow_udf(_SKETCH)
def _sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        n, digests, bands, signatures = [], [], [], []
        for run in runs(texts):
            for hashes in shingle_sets(run):
                n.append(len(hashes))
                digests.append(hashlib.sha256(hashes.tobytes()).digest()[:16])
                values = bin_values(hashes) if len(hashes) else None
                bands.append([] if values is None else band_keys(values))
                signatures.append(b"" if values is None else mix(values).astype(np.uint8).tobytes())
        yield pa.StructArray.from_arrays(
            [
                pa.array(n, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(signatures, pa.binary()),
            ],
            _SKETCH.names,
        )


@F.arrow_udf(T.ArrayType(T.LongType()))
def _shingles(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        sets = [hashes.view(np.int64) for run in runs(texts) for hashes in shingle_sets(run)]
        yield pa.array(sets, pa.list_(pa.int64()))


@F.arrow_udf(T.IntegerType())
def _agreeing(left: pa.Array, right: pa.Array) -> pa.Array:
    """How many of the signatures' values agree; a value is a byte of a hash."""
    a, b = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(-1, BINS) for x in (left, right))
    return pa.array((a == b).sum(axis=1), pa.int32())


def _linked(percent: int):
    @F.arrow_udf(T.BooleanType())
    def linked(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            out = []
            for a, b in zip(left, right, strict=True):
                x, y = (next(shingle_sets(pa.array([t.as_py()], pa.string()))) for t in (a, b))
                out.append(len(x) > 0 and len(y) > 0 and similar(x, y, percent))
            yield pa.array(out, pa.bool_())

    return linked


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, kept.

    A set holds the distinct runs of five words; with fewer words, the whole sequence. Documents are linked if their
    sets overlap by `percent` of their union or more.

    - A null or blank text has an empty set and is linked with nothing. Texts of any length are taken whole.
    - component_id is the smallest doc_id that can be reached, itself included. Rows that repeat an id are one document.
    - A row without an id joins its class if that has an id; else its component_id is null and it is kept.
    - An empty table gives an empty result. Other columns, whatever their names, are not read.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    sketch = cut(docs.select("doc_id", _sketch(F.col("text")).alias("s")).select("doc_id", "s.*"))
    classes = sketch.where("n > 0").groupBy("digest", "n", "bands", "signature").agg(F.min("doc_id").alias("first"))
    classes = cut(classes)
    firsts = classes.where("first is not null")
    members = cut(_shared(firsts.select("first", "n", F.explode("bands").alias("bucket"))))
    stars = members.where(_near_size(F.col("n"), F.col("centre.n"), percent))
    stars = stars.select(F.col("centre.first").alias("a"), F.col("first").alias("b"))
    links = _confirmed(stars, firsts, docs, percent)
    labels = components(links)
    for way in (lambda mixed: _second_pass(mixed, percent), lambda mixed: _exact_pairs(mixed, docs, percent)):
        members, mixed = _mixed(members, labels)
        if mixed is None:
            break
        if (left := way(mixed)) is not None:
            links = links.unionAll(_confirmed(left, firsts, docs, percent))
            labels = components(links)
    return _result(sketch, classes, labels)


def _near_size(n: Column, other: Column, percent: int) -> Column:
    """Whether sets of these sizes can overlap by `percent`."""
    return 100 * F.least(n, other) >= percent * F.greatest(n, other)


def _shared(members: DataFrame) -> DataFrame:
    """Members of buckets that have more than one, with the smallest of the bucket as its centre."""
    centres = members.groupBy("bucket").agg(F.min(F.struct("first", "n")).alias("centre"), F.count("*").alias("size"))
    return members.join(centres.where("size > 1").drop("size"), "bucket")


def _mixed(members: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The members (bucket, first, n) of buckets that hold several components, and with root and size; None if there are none."""
    rooted = members.select("bucket", "first", "n").join(labels, F.col("first") == F.col("node"), "left")
    rooted = cut(rooted.select("bucket", "first", "n", F.coalesce("root", "first").alias("root")))
    size = F.count("*").alias("size")
    kinds = rooted.groupBy("bucket").agg(size, F.min("root").alias("low"), F.max("root").alias("high"))
    # Of a bucket of two, the star was the only pair.
    mixed = cut(rooted.join(kinds.where("low < high and size > 2").select("bucket", "size"), "bucket"))
    return mixed, None if mixed.isEmpty() else mixed


def _second_pass(mixed: DataFrame, percent: int) -> DataFrame:
    """Candidates (a, b) between components: all of small buckets, further stars of large ones."""
    near = _near_size(F.col("n"), F.col("n_b"), percent) & (F.col("root") != F.col("root_b"))
    small = mixed.where(F.col("size") <= SMALL_BUCKET).select("bucket", "first", "n", "root")
    other = small.toDF("bucket", "b", "n_b", "root_b")
    edges = small.join(other, "bucket").where((F.col("first") < F.col("b")) & near).select(F.col("first").alias("a"), "b")
    large = mixed.where(F.col("size") > SMALL_BUCKET).select("bucket", "first", "n", "root")
    firsts = [F.min(F.struct(F.xxhash64("first", "bucket", F.lit(k)).alias("order"), "first", "n", "root")) for k in range(ORDERS)]
    centres = large.groupBy("bucket").agg(F.array(*firsts).alias("centres"))
    stars = large.join(centres, "bucket").select("first", "n", "root", F.inline("centres").alias("order", "a", "n_b", "root_b"))
    return edges.unionAll(stars.where(near).select("a", F.col("first").alias("b")))


def _exact_pairs(mixed: DataFrame, docs: DataFrame, percent: int) -> DataFrame | None:
    """Candidates (a, b) that connect all linked documents of large buckets; None if no large bucket is mixed."""
    large = cut(mixed.where(F.col("size") > SMALL_BUCKET).select("first", "root").distinct())
    if not (n_large := large.count()):
        return None
    texts = _texts(docs, large.select(F.col("first").alias("id")), n_large)
    # Rows that repeat an id may have several sets.
    sets = texts.select("doc_id", _shingles("text").alias("shingles")).where(F.size("shingles") > 0)
    sets = cut(sets.join(large, F.col("doc_id") == F.col("first")).withColumn("id", F.monotonically_increasing_id()))
    names = sets.select("id", "first")
    pairs = _pairs(sets.select("id", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle")), percent)
    pairs = pairs.join(names.toDF("a", "first_a"), "a").join(names.toDF("b", "first_b"), "b")
    return pairs.select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))


def _pairs(rows: DataFrame, percent: int, most: int = COMMON) -> DataFrame:
    """From the parts of sets in `rows` (id, root, n, shingle), pairs (a, b) of ids that connect all linked sets.

    A part is the set itself or what it has of certain shingles; n is the size of the set. Looked for are pairs whose parts
    alone share enough for `percent` of the union. Sets of one root that is not null are connected already. Linked sets
    share `percent` of n or more, called least, so of a part of m shingles the first m - least + 1 are its prefix, and the
    prefixes of a pair share a shingle. Shingles of more than `most` parts come last in the order. A pair that shares a
    rarer one in the prefixes is found by it. Any other pair shares common shingles only, and in both parts least or more
    are common. Such sets are grouped by their common shingles. Two linked sets of one group are both linked with the
    group's smallest set, and of two groups, each with the smallest of the other; what links a set links the smallest of
    its group and root as well, if the root is not null. Pairs of groups are found in the same way, by their smallest sets, with a higher bound.
    """
    common = rows.groupBy("shingle").agg(F.count("*").alias("sets")).where(F.col("sets") > most)
    common = common.select(F.col("shingle").alias("common"))
    entry = F.struct(F.col("common").isNotNull().alias("common"), "shingle")
    sets = rows.join(common, F.col("shingle") == F.col("common"), "left")
    sets = sets.groupBy("id", "root", "n").agg(F.sort_array(F.collect_list(entry)).alias("all"))
    size = F.size("all").alias("size")
    least = F.floor((percent * F.col("n") + 99) / 100).cast("int")
    sets = sets.where(size >= least)
    rare = F.filter(F.slice("all", F.lit(1), size - least + 1), lambda x: ~x["common"])["shingle"]
    often = F.filter("all", lambda x: x["common"])["shingle"]
    part = F.col("all")["shingle"].alias("part")
    sets = cut(sets.select("id", "root", "n", size, part, rare.alias("rare"), F.when(F.size(often) >= least, often).alias("often")))
    apart = F.coalesce(F.col("root") != F.col("root_b"), F.lit(True))
    enough = (100 + percent) * F.least("size", "size_b") >= percent * (F.col("n") + F.col("n_b"))
    one = sets.select("n", "size", "root", F.col("id").alias("a"), F.explode("rare").alias("shingle"))
    other = one.toDF("n_b", "size_b", "root_b", "b", "shingle")
    found = one.join(other, "shingle").where((F.col("a") < F.col("b")) & enough & apart).select("a", "b").distinct()
    # Pairs whose parts share too little go before they stand for the pairs of whole groups.
    left, right = (sets.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("part").alias(f"part_{x}")) for x in "ab")
    shared = F.size(F.array_intersect("part_a", "part_b"))
    found = found.join(left, "a").join(right, "b")
    found = found.where((100 + percent) * shared >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")

    members = sets.where("often is not null").withColumn("of", F.sha2(F.array_join("often", ","), 256))
    first = F.min(F.struct("n", "id"))
    alone = F.when(F.col("root").isNull(), F.col("id")).alias("alone")
    members = cut(members.groupBy("of", "root", alone).agg(first.alias("at"), F.first("often").alias("often")))
    # The only root of a group, if it has only one.
    only = F.when((F.min("root") == F.max("root")) & (F.count("root") == F.count("*")), F.min("root")).alias("only")
    groups = members.groupBy("of").agg(F.min(F.struct("at.n", "at.id", "root")).alias("centre"), only, F.first("often").alias("often"))
    groups = cut(groups.withColumn("group", F.monotonically_increasing_id()))
    n_groups = groups.count()
    if not n_groups:
        return found
    size = F.size("often")
    centres = groups.select(
        "of", "group", F.col("centre.id").alias("b"), F.col("centre.n").alias("n_b"), F.col("centre.root").alias("root_b"), size.alias("size_b")
    )
    members = members.select("of", F.col("at.id").alias("a"), F.col("at.n").alias("n"), "root", size.alias("size"))
    near = groups.select("group", F.col("group").alias("to"))
    if n_groups > 1:
        parts = groups.select(F.col("group").alias("id"), F.col("only").alias("root"), F.col("centre.n").alias("n"), F.explode("often").alias("shingle"))
        further = cut(_pairs(parts, percent, most * COMMON_STEP)).toDF("group", "to")
        near = near.unionAll(further).unionAll(further.select("to", "group"))
    marked = centres.select("of", "group")
    if n_groups <= BROADCAST_GROUPS:
        centres, marked = F.broadcast(centres), F.broadcast(marked)
    tops = near.join(centres.drop("of").withColumnRenamed("group", "to"), "to").drop("to")
    pairs = members.join(marked, "of").join(tops, "group").where((F.col("a") != F.col("b")) & apart & enough)
    return found.unionAll(pairs.select("a", "b"))


def _confirmed(edges: DataFrame, firsts: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The edges that are links. Sizes and signatures rule out most of the others before any text is moved."""
    sketch = firsts.select("first", "n", "signature")
    left = sketch.toDF("a", "n_a", "signature_a")
    right = sketch.toDF("b", "n_b", "signature_b")
    close = _near_size(F.col("n_a"), F.col("n_b"), percent)
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    likely = edges.join(left, "a").join(right, "b").where(close)
    likely = cut(likely.where(_agreeing("signature_a", "signature_b") >= LEAST_AGREEING).select("a", "b"))
    texts = _texts(docs, likely.select(F.explode(F.array("a", "b")).alias("id")).distinct(), 2 * likely.count())
    pairs = likely.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return cut(pairs.where(_linked(percent)("text_a", "text_b")).select("a", "b").distinct())


def _texts(docs: DataFrame, ids: DataFrame, most: int) -> DataFrame:
    """The rows of `docs` with one of `ids`, at most `most`; few ids are broadcast, so that only these texts are moved."""
    if most <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, F.col("doc_id") == F.col("id"), "left_semi")


def _result(sketch: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    named = classes.join(labels, F.col("first") == F.col("node"), "left")
    named = named.select(F.col("digest").alias("of"), F.coalesce("root", "first").alias("component"))
    rows = sketch.select("doc_id", "n", "digest").join(named, F.col("digest") == F.col("of"), "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return rows.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of each component the document with the smallest id.

    Rows that repeat an id stay or go together. Rows without an id stay if nothing with an id is equal to them.
    """
    gone = near_duplicates(docs, **how).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == F.col("_gone"), "left_anti")

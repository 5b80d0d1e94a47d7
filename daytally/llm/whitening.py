"""Whitening of embeddings without forming their covariance.

Each task centres its vectors and keeps only the triangular factor R of all rows it has seen; the factors of the tasks
are stacked and factored again until one is left. The singular values and right singular vectors of that R (see
`bidiagonal`) are the square roots of the covariance's eigenvalues, but for the number of vectors, and its eigenvectors.
Sums are exact integers, and a vector is centred before anything is multiplied.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.bidiagonal import singular
from daytally.llm.common import bounded_batches, cut
from daytally.llm.vector_search import finite

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Rows that are factored at once, and factors that one task merges.
BLOCK_ROWS = 4096
FAN_IN = 32
#: Singular values below this, relative to the largest, are rounding: their components have no variance to divide by.
RANK_LIMIT = 1e-12
_LONGEST = 2**63 - 1

_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """Lists of `width` numbers each, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """The vectors of a task in blocks of about BLOCK_ROWS."""
    held: list[np.ndarray] = []
    for batch in batches:
        held.append(_rows(batch.column("x"), width))
        if sum(map(len, held)) >= BLOCK_ROWS:
            yield np.concatenate(held)
            held = []
    if held:
        yield np.concatenate(held)


def _one(name: str, kind: pa.DataType, values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values], pa.list_(kind))], names=[name])


class _Centre:
    """Number and sums of the fit list."""

    def __init__(self, n: int, sums: np.ndarray):
        self.n, self.sums = n, sums

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact."""
        return x * np.int64(self.n) - self.sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x) / float(self.n)


def _summed(parts: DataFrame, name: str, size: int) -> np.ndarray:
    """The sum of the lists in all rows; only `size` numbers reach the driver."""
    rows = parts.select(F.posexplode(name).alias("at", "part")).groupBy("at").agg(F.sum("part").alias("total")).collect()
    out = [0] * size
    for row in rows:
        out[row["at"]] = row["total"]
    return np.array(out)


def _centre(fit: DataFrame, width: int) -> _Centre:
    def sums(batches):
        total = np.zeros(width + 1, np.int64)
        for block in _blocks(batches, width):
            total += np.append(len(block), block.sum(axis=0))
        yield _one("sums", pa.int64(), total)

    total = _summed(fit.mapInArrow(sums, "sums array<long>"), "sums", width + 1)
    return _Centre(int(total[0]), total[1:].astype(np.int64))


def _triangle(fit: DataFrame, centre: _Centre, width: int) -> np.ndarray:
    """R of the centred vectors."""

    def factored(r: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.linalg.qr(np.concatenate([r, rows]), mode="r")

    def factors(batches):
        r = np.zeros((0, width))
        for block in _blocks(batches, width):
            r = factored(r, centre.centred(block))
        if len(r):
            yield _one("r", pa.float64(), r.ravel())

    def merged(batches):
        r = np.zeros((0, width))
        for batch in batches:
            for one in batch.column("r"):
                r = factored(r, one.values.to_numpy().reshape(-1, width))
        if len(r):
            yield _one("r", pa.float64(), r.ravel())

    parts = cut(fit.mapInArrow(factors, "r array<double>"))
    left = parts.count()
    while left > 1:
        left = -(-left // FAN_IN)
        parts = cut(parts.repartition(left).mapInArrow(merged, "r array<double>"))
    found = np.array(parts.first()["r"]).reshape(-1, width)
    square = np.zeros((width, width))
    square[: len(found)] = found[:width]
    return square


def directions(fit: DataFrame, centre: _Centre, width: int, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Columns that whiten a centred vector, and the share of the variance that each explains."""
    squares, vectors = singular(_triangle(fit, centre, width))
    kept = int((squares[:most] > squares[0] * RANK_LIMIT**2).sum()) if width and squares[0] > 0 else 0
    values = squares[:kept] / centre.n
    return vectors[:kept].T / np.sqrt(values), squares[:kept] / squares.sum() if kept else np.zeros(0)


def _identity_error(fit: DataFrame, centre: _Centre, width: int, whitening: np.ndarray) -> float:
    """How far the covariance of the whitened fit list is from the identity."""
    kept = whitening.shape[1]

    def products(batches):
        total = np.zeros((kept, kept))
        for block in _blocks(batches, width):
            white = centre.centred(block) @ whitening
            total += white.T @ white
        yield _one("products", pa.float64(), total.ravel())

    total = _summed(fit.mapInArrow(products, "products array<double>"), "products", kept * kept)
    return float(np.abs(total.reshape(kept, kept) / centre.n - np.eye(kept)).max())


def _deviation(rows: np.ndarray) -> list[int | None]:
    """Sums of squares, exact; None where a 64-bit integer does not hold one."""
    if np.abs(rows).max(initial=0) < (1 << 31) / max(1.0, rows.shape[1] ** 0.5):
        return (rows * rows).sum(axis=1).tolist()
    return [s if (s := sum(int(c) ** 2 for c in row)) <= _LONGEST else None for row in rows]


def whitened(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """For each row of `vectors` (vec_id, embedding) and each of the first `most` components: vec_id, component, n, deviation,
    whitened, explained, identity_error.

    Entries count as floor(64 * entry) + 1,000,000. The distinct vectors are the fit list; n is their number, and all
    covariances are over them. Component 1 has the largest variance. deviation is the exact squared distance from the mean,
    times n squared; null if it is beyond 64 bits.

    - Vectors that are null or hold a null or a number that is not finite are dropped, as are empty ones, and those that are
      shorter than the longest. A row without vec_id is a row like others.
    - Repeated rows and equal vectors are one entry of the fit list, and each row is returned.
    - Components without variance are not returned: with n vectors there are n - 1 at most, and none for an empty table or
      equal vectors. Components of equal variance are any orthogonal ones.
    - Other columns, whatever their names, are not read.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    entry = F.transform("embedding", lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long") + OFFSET).alias("x")
    rows = vectors.select("vec_id", "embedding").where(finite(F.col("embedding")) & (F.size("embedding") > 0))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), entry)
    fit = cut(rows.select("x").distinct())
    width = fit.agg(F.max(F.size("x"))).first()[0] or 0
    if not width:
        return spark.createDataFrame([], _OUT)
    fit = fit.where(F.size("x") == width)
    centre = _centre(fit, width)
    whitening, explained = directions(fit, centre, width, most)
    kept = len(explained)
    if not kept:
        return spark.createDataFrame([], _OUT)
    error = _identity_error(fit, centre, width, whitening)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deviations = centre.deviations(_rows(batch.column("x"), width))
            white = (deviations / float(centre.n)) @ whitening
            many = len(white) * kept
            repeated = pa.array(np.repeat(np.arange(len(white)), kept))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(repeated),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(white))),
                    pa.array(np.full(many, centre.n)),
                    pa.array(_deviation(deviations), pa.int64()).take(repeated),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, len(white))),
                    pa.array(np.full(many, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.where(F.size("x") == width).mapInArrow(projected, _OUT)

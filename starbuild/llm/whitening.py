"""Embedding whitening with a bit-sliced scatter matrix.

Entries become integers (``floor(256 * entry)``), and the covariance of the distinct integer vectors is
computed without rounding.  Each task takes its vectors in blocks of ``BLOCK``: it shifts every dimension
by its smallest value, cuts the rest into bit planes and packs each plane across the rows into 64-bit
words.  The cross-product of two dimensions is then the sum over their pairs of planes of
``2^(a+b) * popcount(plane_a AND plane_b)``, and the shift is undone in integers.  A task adds up its
blocks and emits one row per pair of dimensions (as two 64-bit parts, so that no sum overflows); Spark adds
these up.  The driver gets one number per pair of dimensions, whatever the number of rows, centres them as
integers (``n * Sxy - Sx * Sy``) and only then goes to floating point and to ``eigh``.

The fit list is stored once: distinct vectors are found with partial aggregation, so a vector that holds a
third of the table leaves each task once.  Rows are projected where they are read.

Defined cases: a NULL vector, or one with NULL or non-finite entries, gives no rows, nor does one whose
length is not the table's commonest (among distinct vectors; the shorter of equally common ones).  Entries
beyond the range of a 64-bit integer saturate; a deviation of over 38 digits is NULL.  NULL and repeated
identifiers pass through, one set of rows per row.  Directions without variance (fewer distinct vectors
than dimensions, constant or dependent dimensions) are no components, so one distinct vector alone, as an
empty table, gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import stage

#: Rows that are bit-sliced together: 256 words a plane.
BLOCK = 16_384
#: Planes per dimension up to which the products of a block fit 64-bit integers.
NARROW = 23
#: Bits of the low part of a sum.
LOW = 40


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id`` and the integer vector ``x`` of the rows whose entries are all finite."""
    entries = F.col(f"`{vec_col}`").cast("array<double>")
    finite = F.forall(entries, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    x = F.transform(entries, lambda e: F.floor(e * 256))
    return vectors.where(finite).select(F.col(f"`{id_col}`").alias("id"), x.alias("x"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def bit_planes(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Planes of the unsigned rows of ``u`` (one row a dimension): packed words, and each plane's dimension and bit."""
    words = -(-u.shape[1] // 64)
    widths = [int(top).bit_length() for top in u.max(axis=1)]
    packed = np.zeros((sum(widths), words * 8), np.uint8)
    dimension = np.repeat(np.arange(len(widths)), widths)
    bit = np.concatenate([np.arange(w) for w in widths]) if len(dimension) else dimension
    for b in range(max(widths, default=0)):
        at = np.flatnonzero(bit == b)
        bits = np.packbits((u[dimension[at]] >> np.uint64(b)).astype(np.uint8) & 1, axis=1)
        packed[at, : bits.shape[1]] = bits
    return packed.view(np.uint64), dimension, bit


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums, and for every pair of dimensions the sum of products, of a block of integer rows."""
    rows, dims = x.shape
    least = x.min(axis=0)
    u = np.ascontiguousarray(x.T).view(np.uint64) - least.view(np.uint64)[:, None]  # exact for any two 64-bit values
    planes, dimension, bit = bit_planes(u)
    narrow = (int(bit.max(initial=0)) <= NARROW) and max(abs(int(least.min())), abs(int(least.max()))) < 1 << NARROW
    kind = np.int64 if narrow else object
    weight = np.array([1 << int(b) for b in bit], kind)
    linear, product = np.zeros(dims, kind), np.zeros((dims, dims), kind)
    counts = np.bitwise_count(planes).sum(axis=1, dtype=np.int64).astype(kind)
    np.add.at(linear, dimension, counts * weight)
    first = np.searchsorted(dimension, np.arange(dims))
    for p in range(len(planes)):
        d = dimension[p]
        rest = planes[first[d] :]
        common = np.bitwise_count(rest & planes[p]).sum(axis=1, dtype=np.int64).astype(kind)
        np.add.at(product[d], dimension[first[d] :], common * weight[first[d] :] * weight[p])
    upper = np.triu(product)
    shift = least.astype(kind)
    back = upper + np.triu(np.outer(shift, linear) + np.outer(linear, shift) + rows * np.outer(shift, shift))
    return linear + rows * shift, back


def _split(values: np.ndarray) -> tuple[list[int], list[int]]:
    """``high * 2^LOW + low`` with ``0 <= low < 2^LOW``."""
    high = values >> LOW
    return high.tolist(), (values - (high << LOW)).tolist()


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: np.ndarray | None = None  # sums as a last row below the products

    def add(x: np.ndarray, total: np.ndarray | None) -> np.ndarray:
        linear, product = cross_products(x)
        found = np.vstack([product, linear[None, :]])
        parts = np.array(_split(found), dtype=np.int64)
        if total is None:
            return parts
        total += parts
        total[0] += total[1] >> LOW
        total[1] &= (1 << LOW) - 1
        return total

    held: list[np.ndarray] = []
    for batch in batches:
        if batch.num_rows:
            held.append(_matrix(batch.column(0)))
        while sum(map(len, held)) >= BLOCK:
            rows = np.concatenate(held)
            total = add(rows[:BLOCK], total)
            held = [rows[BLOCK:]]
    if sum(map(len, held)):
        total = add(np.concatenate(held), total)
    if total is not None:
        dims = total.shape[2]
        for j in range(dims + 1):  # a dimension's row at a time
            k = np.arange(j if j < dims else 0, dims, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(k), j, np.int32)), pa.array(k), pa.array(total[0, j, k]), pa.array(total[1, j, k])], names=["j", "k", "high", "low"]
            )


def covariance(fit: DataFrame, dims: int, n: int) -> tuple[list[int], np.ndarray]:
    """Sums per dimension and the covariance (divisor ``n``) of the integer vectors ``x``, centred without rounding."""
    slim = fit.select("x").mapInArrow(_scatter, "j int, k int, high long, low long")
    added = slim.groupBy("j", "k").agg(F.sum("high"), F.sum("low")).collect()  # one row a pair of dimensions
    exact = {(j, k): (high << LOW) + low for j, k, high, low in added}
    sums = [exact[dims, k] for k in range(dims)]
    v = np.zeros((dims, dims))
    for j in range(dims):
        for k in range(j, dims):
            v[j, k] = v[k, j] = (n * exact[j, k] - sums[j] * sums[k]) / (n * n)
    return sums, v


def components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and, as columns, unit eigenvectors of those that carry variance, at most ``most``."""
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    used = min(most, int((values > values[0] * len(values) * np.finfo(float).eps).sum())) if values[0] > 0 else 0
    return values[:used], vectors[:, :used]


class Whitener:
    """Projects integer vectors; travels to the tasks."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray):
        self.n, self.sums = n, sums
        self._scaled = vectors / np.sqrt(values)

    def __call__(self, x: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Deviations (exact), and the whitened coordinates, one column a component."""
        reach = self.n * (max(abs(int(x.min())), abs(int(x.max()))) + 1) + max(map(abs, self.sums))
        kind = np.int64 if reach * reach * x.shape[1] < 1 << 63 else object
        centred = x.astype(kind) * self.n - np.array(self.sums, kind)
        squares = (centred * centred).sum(axis=1)
        if kind is object:
            squares = [Decimal(s) if s < 10**38 else None for s in squares]
        deviation = pa.array(squares).cast(pa.decimal128(38, 0)) if kind is np.int64 else pa.array(squares, pa.decimal128(38, 0))
        return deviation, (centred / self.n).astype(float) @ self._scaled


def _identity_error(fit: DataFrame, whitener: Whitener, used: int, n: int) -> float:
    """Largest entry of the whitened fit list's covariance less the identity."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments = np.zeros((used, used))
        for batch in batches:
            if batch.num_rows:
                z = whitener(_matrix(batch.column(0)))[1]  # centred: its mean is zero
                moments += z.T @ z
        cells = [(j, k) for j in range(used) for k in range(used)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([c[i] for c in cells], pa.int32()) for i in (0, 1)] + [pa.array(moments.ravel())], names=["j", "k", "m"]
        )

    added = fit.select("x").mapInArrow(add_up, "j int, k int, m double").groupBy("j", "k").agg(F.sum("m")).collect()
    return max(abs(m / n - (j == k)) for j, k, m in added)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", most: int = 4) -> DataFrame:
    """Per row and component: ``id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    rows = integer_vectors(vectors, id_col, vec_col)
    distinct = stage(rows.select("x").distinct(), "distinct-vectors")
    lengths = distinct.groupBy(F.size("x").alias("dims")).agg(F.count("*").alias("n"))
    found = lengths.where("dims > 0").orderBy(F.desc("n"), "dims").head(1)
    kind = rows.schema["id"].dataType.simpleString()
    if found:
        dims, n = found[0]
        fit = distinct.where(F.size("x") == dims)
        sums, v = covariance(fit, dims, n)
        values, coordinates = components(v, most)
    if not found or not len(values):
        fields = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], fields)
    whitener = Whitener(n, sums, values, coordinates)
    error = _identity_error(fit, whitener, len(values), n)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                deviation, z = whitener(_matrix(batch.column(1)))
                coordinates = pa.ListArray.from_arrays(np.arange(0, z.size + 1, z.shape[1], dtype=np.int32), pa.array(z.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), deviation, coordinates], names=["id", "deviation", "z"])

    projected = rows.where(F.size("x") == dims).mapInArrow(project, f"id {kind}, deviation decimal(38,0), z array<double>")
    explained = F.array(*[F.lit(float(e / np.trace(v))) for e in values])
    return projected.select("id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        "id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )

"""Whitening of embeddings from exact cross-products by bit slices.

Entries become integers, ``x = floor(scale * c) + offset``. The fit list is each distinct x vector once. Per dimension,
x minus the dimension's least value is a small unsigned number; its bits are packed across rows into 64-bit words, one row of
words per bit plane. The number of rows with both of two bits set is the popcount of the AND of two planes, so a
cross-product is a sum of popcounts weighted by powers of two: exact integers throughout. Tasks add them up per
block of rows; Spark adds up the tasks. The driver gets one number per pair of dimensions (and 16 bits of weight), centres them
as Python integers, ``n * sum(xy) - sum(x) * sum(y)``, and only then turns them to floating point for ``eigh``.

Weights go by limbs of 16 bits, so sums fit 64 bits for up to 2^41 rows whatever the range of x. The driver and each task hold
matrices of dimensions squared, so this is for up to a few thousand dimensions.

Defined results: rows whose vector is null or holds null or non-finite entries are left out; vectors of different lengths are fitted apart;
entries whose ``scale * c`` is beyond 2^52 count as that; components whose eigenvalue is not above the rounding error of the
greatest one are left out, so copies of one vector, empty vectors and an empty table give no components;
repeated rows are transformed each; other columns stay, in the struct ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconfold.llm.common import discard, staged, table

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
LIMIT = float(1 << 52)
#: Rows sliced at a time, and bytes that their integers may take.
BLOCK_ROWS, BLOCK_BYTES = 1 << 16, 32 << 20
LIMB = 16
RANGES = "size int, dimension int, low bigint, high bigint, n bigint"
SUMS = "limb int, a int, b int, total bigint"


def usable(vector: Column) -> Column:
    """Not null, and all entries finite."""
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))), F.lit(False))


def integers(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """The integers of a vector's entries."""

    def one(c: Column) -> Column:
        return F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(LIMIT)), F.lit(-LIMIT))) + offset

    return F.transform(vector, one)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least and greatest value per length and dimension, and the number of vectors, of this task."""
    found: dict[int, list] = {}
    for batch in batches:
        x = batch.column("x")
        sizes = batch.column("size").to_numpy()
        for size in np.unique(sizes):
            rows = _matrix(x.filter(pa.array(sizes == size)), int(size))
            low, high, n = found.get(size, (rows[0], rows[0], 0))
            found[size] = (np.minimum(low, rows.min(axis=0)), np.maximum(high, rows.max(axis=0)), n + len(rows))
    for size, (low, high, n) in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(size, size, np.int32)), pa.array(np.arange(size, dtype=np.int32)), pa.array(low), pa.array(high), pa.array(np.full(size, n, np.int64))],
            ["size", "dimension", "low", "high", "n"],
        )


def _planes(rows: np.ndarray, low: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Bit planes of the shifted columns, dimension by dimension from the lowest bit: (planes, words)."""
    words = -(-len(rows) // 64)
    out = np.zeros((int(bits.sum()), words * 8), np.uint8)
    at = 0
    for d, width in enumerate(bits):
        column = (rows[:, d] - low[d]).view(np.uint64)
        for p in range(width):
            packed = np.packbits(((column >> np.uint64(p)) & np.uint64(1)).astype(bool))
            out[at, : len(packed)] = packed
            at += 1
    return out.view(np.uint64)


def _scatter(low: np.ndarray, bits: np.ndarray):
    """Cross-products and sums of a task's shifted columns, as 16-bit limbs: a is -1 for the sum of column b."""
    size = len(low)
    of = np.repeat(np.arange(size), bits)
    bit = np.concatenate([np.arange(b) for b in bits]) if size else np.zeros(0, int)
    limbs = max(1, -(-(2 * int(bits.max(initial=1)) - 1) // LIMB))
    block = int(max(64, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, size)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((limbs, size, size), np.int64)
        sums = np.zeros((limbs, size), np.int64)

        def add(rows: np.ndarray) -> None:
            planes = _planes(rows, low, bits)
            for i in range(len(planes)):
                counts = np.bitwise_count(planes[i] & planes[i:]).sum(axis=1, dtype=np.int64)
                weight = bit[i] + bit[i:]
                # Two planes of one dimension stand for both orders; a pair of dimensions is kept once, the lower first.
                counts[1:] <<= (of[i + 1 :] == of[i]).astype(np.int64)
                np.add.at(products, (weight // LIMB, of[i], of[i:]), counts << (weight % LIMB))
                sums[bit[i] // LIMB, of[i]] += counts[0] << (bit[i] % LIMB)

        held: list[np.ndarray] = []
        for batch in batches:
            rows = _matrix(batch.column("x"), size)
            while len(rows):
                take = rows[: block - sum(map(len, held))]
                held.append(take)
                rows = rows[len(take) :]
                if sum(map(len, held)) == block:
                    add(np.concatenate(held))
                    held = []
        if held:
            add(np.concatenate(held))
        for totals, cells in ((products, np.nonzero(products)), (sums, np.nonzero(sums))):
            limb, *ab = (c.astype(np.int32) for c in cells)
            a, b = ab if len(ab) == 2 else (np.full(len(limb), -1, np.int32), ab[0])
            yield pa.RecordBatch.from_arrays([pa.array(limb), pa.array(a), pa.array(b), pa.array(totals[cells])], ["limb", "a", "b", "total"])

    return run


@dataclass(frozen=True)
class Whitening:
    """What vectors of one length are whitened by."""

    n: int
    sums: tuple[int, ...]
    #: Greatest distance of a value from its dimension's least, for telling whether 64 bits suffice.
    spread: int
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else self.values

    def transform(self, x: np.ndarray) -> tuple[list[int] | np.ndarray, np.ndarray]:
        """Deviations, exact, and the whitened rows."""
        if len(self.sums) * (self.n * max(1, self.spread)) ** 2 < 1 << 62 and (self.n + 1) * int(np.abs(x).max(initial=1)) < 1 << 62:
            centred = self.n * x - np.array(self.sums, np.int64)
            deviation = (centred * centred).sum(axis=1)
        else:
            centred = self.n * x.astype(object) - np.array(self.sums, object)
            deviation = [int(v) for v in (centred * centred).sum(axis=1)]
        unit = (centred / self.n).astype(np.float64)
        return deviation, unit @ self.vectors / np.sqrt(self.values)


def solve(products: list[list[int]], sums: list[int], low: list[int], n: int, spread: int, components: int) -> Whitening:
    """Centre as integers, then eigenvectors of the covariance."""
    size = len(sums)
    # V = (n P - S S') / n^2; dividing Python integers rounds once.
    square = n * n
    covariance = np.array(
        [[(n * products[min(i, j)][max(i, j)] - sums[i] * sums[j]) / square for j in range(size)] for i in range(size)], np.float64
    ).reshape(size, size)
    values, vectors = np.linalg.eigh(covariance) if size else (np.zeros(0), np.zeros((0, 0)))
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = np.flatnonzero(values > max(values[:1].max(initial=0.0), 0.0) * size * np.finfo(float).eps)[:components]
    whole = tuple(s + n * a for s, a in zip(sums, low, strict=True))
    return Whitening(n, whole, spread, values[kept], vectors[:, kept], float(np.trace(covariance)))


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """Per vector length, the whitening of ``distinct`` (size, x), which is read twice and a third time per length."""
    ranges = distinct.where("size > 0").mapInArrow(_ranges, RANGES).groupBy("size", "dimension")
    found: dict[int, list] = {}
    for r in ranges.agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).collect():
        found.setdefault(r["size"], []).append((r["dimension"], r["low"], r["high"], r["n"]))
    made = {}
    for size, rows in found.items():
        rows.sort()
        low, high, n = [r[1] for r in rows], [r[2] for r in rows], rows[0][3]
        bits = np.array([(h - a).bit_length() for a, h in zip(low, high, strict=True)])
        task = _scatter(np.array(low, np.int64), bits)
        totals = distinct.where(F.col("size") == size).select("x").mapInArrow(task, SUMS).groupBy("limb", "a", "b").agg(F.sum("total").alias("total"))
        products, sums = [[0] * size for _ in range(size)], [0] * size
        for limb, a, b, total in totals.collect():  # at most (size + 1) * size numbers a limb
            if a < 0:
                sums[b] += total << (LIMB * limb)
            else:
                products[a][b] += total << (LIMB * limb)
        spread = max(h - a for a, h in zip(low, high, strict=True))
        made[size] = solve(products, sums, low, n, spread, components)
    return made


def _whiten(fitted: dict[int, Whitening]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                own = batch.filter(pa.array(sizes == size))
                by = fitted.get(int(size))
                if by is None or not len(by.values):
                    continue
                deviation, white = by.transform(_matrix(own.column("x"), int(size)))
                many, k = white.shape
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, many * k + 1, k, dtype=np.int32)), pa.array(np.ascontiguousarray(white).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [own.column("row"), own.column("size"), pa.array([str(v) for v in deviation]), lists], ["row", "size", "deviation", "whitened"]
                )

    return run


def apply(vectors: DataFrame, fitted: dict[int, Whitening]) -> DataFrame:
    """``vectors`` (row, size, x) as (row, size, deviation: decimal text, whitened: array of components)."""
    added = [T.StructField("size", T.IntegerType()), T.StructField("deviation", T.StringType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    return vectors.mapInArrow(_whiten(fitted), T.StructType([vectors.schema["row"], *added]))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length, sums and cross-products of whitened rows, which are centred already."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        sizes, white = batch.column("size").to_numpy(), batch.column("whitened")
        for size in np.unique(sizes):
            own = white.filter(pa.array(sizes == size))
            w = _matrix(own, len(own[0]))
            w = np.column_stack([np.ones(len(w)), w])
            found[size] = found.get(size, 0.0) + w.T @ w
    for size, m in found.items():
        a, b = (c.ravel().astype(np.int32) for c in np.indices(m.shape))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), size, np.int32)), pa.array(a), pa.array(b), pa.array(m.ravel())], ["size", "a", "b", "total"])


def identity_errors(distinct: DataFrame, fitted: dict[int, Whitening]) -> dict[int, float]:
    """Per length, how far the covariance of the whitened fit list is from the identity, measured on its rows."""
    white = apply(distinct.select(F.lit(None).cast("int").alias("row"), "size", "x"), fitted).select("size", "whitened")
    totals = white.mapInArrow(_moments, "size int, a int, b int, total double").groupBy("size", "a", "b").agg(F.sum("total").alias("total"))
    cells: dict[int, dict] = {}
    for size, a, b, total in totals.collect():
        cells.setdefault(size, {})[a, b] = total
    errors = {}
    for size, m in cells.items():
        k, n = len(fitted[size].values), m[0, 0]
        gaps = [abs(m[i, j] / n - m[0, i] * m[0, j] / n / n - (i == j)) for i in range(1, k + 1) for j in range(1, k + 1)]
        errors[size] = max(gaps)
    return errors


def whiten(
    vectors: DataFrame, column: str = "embedding", scale: int = SCALE, offset: int = OFFSET, components: int = COMPONENTS
) -> tuple[DataFrame, dict[int, Whitening], dict[int, float]]:
    """All usable rows as (row, size, deviation, whitened), the whitening per length, and its measured errors."""
    good = vectors.where(usable(F.col(column))).withColumn(column, integers(F.col(column), scale, offset))
    kept = [F.col(f"`{c}`") for c in good.columns if c != column] or [F.lit(None).cast("int").alias("none")]
    read = good.select(F.struct(*kept).alias("row"), F.size(column).alias("size"), F.col(column).alias("x"))
    # Copies collapse in the map tasks, so a vector that a third of all rows have is one row a task.
    distinct, place = staged(read.select("size", "x").distinct(), "fit-list")
    fitted = fit(distinct, components)
    errors = identity_errors(distinct, fitted)
    discard(vectors.sparkSession, place)
    return apply(read, fitted), fitted, errors


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white, fitted, errors = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    stats = [
        (size, k + 1, w.n, float(share), float(errors[size])) for size, w in fitted.items() for k, share in enumerate(w.explained) if size in errors
    ]
    # At most 16 rows per vector length.
    known = F.broadcast(spark.createDataFrame(stats, "size int, component int, n bigint, explained double, identity_error double"))
    each = white.select(F.col("row.vec_id").alias("vec_id"), "size", F.expr("try_cast(deviation AS bigint)").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    return each.withColumn("component", F.col("at") + 1).join(known, ["size", "component"]).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    )

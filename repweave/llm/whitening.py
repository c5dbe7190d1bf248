"""Embedding whitening (operator 13) by bit-sliced scatter.

Entries become integers, x = floor(1024 c) + 100000. A task takes its rows in blocks, shifts each
dimension by the block's minimum and packs every bit of the shifted entries, across rows, into
64-bit words (a bit plane). The popcount of two planes ANDed, weighted by the planes' powers of
two, gives the exact cross-products of two dimensions, and the shift is undone in integers. A
task gives one row per pair of dimensions; Spark sums them. The driver sees d x d numbers: the
scatter is centred as integers, n C - S S', and only then divided for ``eigh``.

Defined cases: rows whose vector is NULL or holds a NULL or non-finite entry are dropped; an empty
vector has no components and gives no rows; vectors of different length are lists of their own, each
with its n; entries beyond 2**62 in size saturate there; a component with no variance (fewer rows than
dimensions, equal rows) has NULL whitened values and stands outside identity_error; explained is NULL
if there is no variance at all; a deviation beyond 64 bits is NULL, ``deviation_wide`` holds it up to 38
digits; repeated rows and ids each count; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repweave.llm.common import batch, bounded_batches, materialise

SCALE, OFFSET = 1024, 100_000
LIMIT = 1 << 62
COMPONENTS = 8
#: Rows of one block of bit planes: 128 words a plane, so planes of a block fit a core's cache.
BLOCK_ROWS = 8192
#: Bits of one limb; products of two limbs summed over a block stay within 64 bits.
LIMB = 20
#: Components below this share of the variance, times the dimension, are rounding alone.
NO_VARIANCE = 1e-14

SCATTER = "dim int, i int, j int, value decimal(38,0)"
SCATTER_ARROW = pa.schema([("dim", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("value", pa.decimal128(38, 0))])


def valid(vector: Column) -> Column:
    """Whether a vector has only finite entries (NaN is above infinity in Spark's order)."""
    return F.coalesce(F.forall(vector, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False))), F.lit(False))


def integers(flat: np.ndarray) -> np.ndarray:
    """x of each entry, as 64-bit integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(flat * SCALE)
    safe = np.clip(scaled, -float(LIMIT), float(LIMIT)).astype(np.int64)
    return safe + OFFSET


def by_length(vectors: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, x as rows x length) for each length but 0 in a batch."""
    ends = vectors.offsets.to_numpy()
    flat = vectors.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(ends)
    for d in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == d)
        yield d, rows, integers(flat[ends[rows][:, None] + np.arange(d)])


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums S_i of x_i and C_ij of x_i x_j over the rows of a block, as Python integers."""
    n, d = x.shape
    low = x.min(axis=0)
    # the span of 64-bit integers can need 64 bits: unsigned differences hold it
    y = x.astype(np.uint64) - low.astype(np.uint64)
    bits = max(int(y.max()).bit_length(), 1)
    words = -(-n // 64)
    planes = np.zeros((bits * d, words * 8), dtype=np.uint8)
    for b in range(bits):
        packed = np.packbits(((y >> np.uint64(b)) & np.uint64(1)).astype(np.uint8).T, axis=1)
        planes[b * d:(b + 1) * d, :packed.shape[1]] = packed
    planes = planes.view(np.uint64)
    count = np.zeros((bits * d, bits * d), dtype=np.int64)
    for p in np.flatnonzero(planes.any(axis=1)).tolist():
        count[p, p:] = np.bitwise_count(planes[p] & planes[p:]).sum(axis=1, dtype=np.int64)
    count = np.triu(count) + np.triu(count, 1).T
    count = count.reshape(bits, d, bits, d)
    limbs = [range(at, min(at + LIMB, bits)) for at in range(0, bits, LIMB)]
    products = np.zeros((d, d), dtype=object)
    sums = np.zeros(d, dtype=object)
    for left in limbs:
        wl = np.array([1 << (b - left[0]) for b in left], dtype=np.int64)
        ones = planes[left[0] * d:(left[-1] + 1) * d]
        ones = np.bitwise_count(ones).sum(axis=1, dtype=np.int64).reshape(len(left), d)
        sums += (wl @ ones).astype(object) * (1 << left[0])
        for right in limbs:
            wr = np.array([1 << (b - right[0]) for b in right], dtype=np.int64)
            part = np.einsum("a,aibj,b->ij", wl, count[left[0]:left[-1] + 1, :, right[0]:right[-1] + 1], wr)
            products += part.astype(object) * (1 << (left[0] + right[0]))
    shift = low.astype(object)
    products += np.outer(shift, sums) + np.outer(sums, shift) + n * np.outer(shift, shift)
    return sums + n * shift, products


def scatter(vectors: DataFrame, vector_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(dim, i, j, value): C_ij for i <= j, S_i as (i, -1), n as (-1, -1), per vector length."""
    bounded_batches(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        total: dict[int, list] = {}

        def flush(d: int) -> None:
            x = np.concatenate(held.pop(d))
            for at in range(0, len(x), block_rows):
                s, c = cross_products(x[at:at + block_rows])
                t = total.setdefault(d, [0, np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)])
                t[0], t[1], t[2] = t[0] + len(x[at:at + block_rows]), t[1] + s, t[2] + c

        for rb in batches:
            for d, _, x in by_length(rb.column(0)):
                held.setdefault(d, []).append(x)
                if sum(map(len, held[d])) >= block_rows:
                    flush(d)
        for d in list(held):
            flush(d)
        for d, (n, s, c) in total.items():
            i, j = np.triu_indices(d)
            values = [Decimal(int(v)) for v in [n, *s, *c[i, j]]]
            yield batch(SCATTER_ARROW, [[d] * len(values), [-1, *range(d), *i.tolist()],
                                        [-1, *[-1] * d, *j.tolist()], values])

    vector = F.col(vector_col).cast("array<double>")
    parts = vectors.where(valid(vector)).select(vector.alias("v")).mapInArrow(run, SCATTER)
    return parts.groupBy("dim", "i", "j").agg(F.sum("value").alias("value"))


class Model:
    """Principal axes of one length's vectors, from exact sums."""

    def __init__(self, n: int, sums: np.ndarray, products: np.ndarray, components: int = COMPONENTS):
        self.n, self.sums = n, sums
        d = len(sums)
        centred = n * products - np.outer(sums, sums)
        cov = np.array([[int(v) / (n * n) for v in row] for row in centred], dtype=np.float64).reshape(d, d)
        values, axes = np.linalg.eigh(cov)
        k = min(components, d)
        self.values = np.maximum(values[::-1][:k], 0.0)
        axes = axes[:, ::-1][:, :k]
        trace = sum(int(centred[i, i]) for i in range(d)) / (n * n)
        self.explained = (self.values / trace).tolist() if trace > 0 else [None] * k
        self.has = self.values > trace * NO_VARIANCE * d
        self.axes = axes / np.sqrt(np.where(self.has, self.values, 1.0))


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> dict[int, Model]:
    """A model per vector length."""
    sums: dict[int, dict[tuple[int, int], int]] = {}
    for r in scatter(vectors, vector_col).collect():
        sums.setdefault(r["dim"], {})[r["i"], r["j"]] = int(r["value"])
    models = {}
    for d, at in sums.items():
        c = np.zeros((d, d), dtype=object)
        for (i, j), v in at.items():
            if j >= 0:
                c[i, j] = c[j, i] = v
        models[d] = Model(at[-1, -1], np.array([at[i, -1] for i in range(d)], dtype=object), c, components)
    return models


WHITE = "id long, dim int, n long, deviation long, deviation_wide decimal(38,0), whitened array<double>, explained array<double>"
WHITE_ARROW = pa.schema([("id", pa.int64()), ("dim", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                         ("deviation_wide", pa.decimal128(38, 0)), ("whitened", pa.list_(pa.float64())),
                         ("explained", pa.list_(pa.float64()))])


def transform(vectors: DataFrame, models: dict[int, Model], id_col: str = "vec_id",
              vector_col: str = "embedding") -> DataFrame:
    """One row per valid vector: its exact deviation and its whitened coordinates."""
    bounded_batches(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for d, rows, x in by_length(rb.column(1)):
                m = models[d]
                reach = m.n * max(abs(int(x.max())), abs(int(x.min()))) + max(abs(int(s)) for s in m.sums)
                off = m.n * x - m.sums.astype(np.int64) if reach < LIMIT else m.n * x.astype(object) - m.sums
                wide = off if d * reach * reach < LIMIT else off.astype(object)
                deviation = [int(v) for v in (wide * wide).sum(axis=1)]
                white = (off.astype(np.float64) / m.n) @ m.axes
                cells = [[v if h else None for v, h in zip(row, m.has.tolist())] for row in white.tolist()]
                yield batch(WHITE_ARROW, [rb.column(0).take(pa.array(rows)), [d] * len(rows), [m.n] * len(rows),
                                          [v if v < 1 << 63 else None for v in deviation],
                                          [Decimal(v) if v < 10 ** 38 else None for v in deviation],
                                          cells, [m.explained] * len(rows)])

    vector = F.col(vector_col).cast("array<double>")
    rows = vectors.where(valid(vector)).select(F.col(id_col).cast("long").alias("id"), vector.alias("v"))
    return rows.mapInArrow(run, WHITE)


def identity_error(whitened: DataFrame, models: dict[int, Model]) -> dict[int, float | None]:
    """The largest entry of |covariance - identity| of the whitened values, per length."""
    k = max((len(m.values) for m in models.values()), default=0)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    if not pairs:
        return {}
    rows = whitened.groupBy("dim").agg(*[
        F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j))).alias(f"c_{i}_{j}") for i, j in pairs]).collect()
    out = {}
    for r in rows:
        off = [abs(r[f"c_{i}_{j}"] - (i == j)) for i, j in pairs if r[f"c_{i}_{j}"] is not None]
        out[r["dim"]] = max(off, default=None)
    return out


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error, deviation_wide): a row per valid
    vector and component."""
    models = fit(vectors, vector_col, components)
    # read twice: for the covariance of all rows, then for the result
    white = materialise(transform(vectors, models, id_col, vector_col), "whitened")
    errors = identity_error(white, models)
    error = F.lit(None).cast("double")
    for d, e in errors.items():
        error = F.when(F.col("dim") == d, F.lit(e).cast("double")).otherwise(error)
    cells = white.withColumn("error", error).select(
        "*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "cell"))
    return cells.select(F.col("id").alias(id_col), (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
                        F.col("cell.whitened").alias("whitened"), F.col("cell.explained").alias("explained"),
                        F.col("error").alias("identity_error"), "deviation_wide")

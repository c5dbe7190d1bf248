"""Mergeable sufficient statistics for replicate-weight means (the cube).

Every mean, replicate SE, contrast and regression in this package is a
function of, per cell, metric m and replicate r = 0..R (0 = full weight):

    n_m    unweighted count of non-NULL values of m
    sw_m   sum of w_r            over rows with m not NULL
    swx_m  sum of w_r * x_m

These sums merge by addition, so the whole grid comes out of ONE scan and ONE
grouped aggregation with map-side partial aggregation; intervals, states,
metros, nation, race groups and complements are roll-ups of that cube. The
cube's size is bounded by the dimension domains (weeks x geographies x race
groups x replicates), not by the number of respondents.

The sums are built in two phases. A task takes respondents as they are, one row each, and adds
weights x indicators as matrices per cell (``task_sums``); what it gives off is one row per cell and
replicate. Spark then merges the tasks' rows with one grouped sum. So no respondent is
ever copied 81 times, and the shuffle holds at most tasks x cube rows.

Layout: replicates are rows (``rep`` 0..R), metrics are columns (3 per metric), narrow enough for
whole-stage codegen. Every replicate has the counts of its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repweave.functions.scalar import interval_label
from repweave.operators.design import ReplicateDesign
from repweave.operators.intervals import interval_column


def n_col(m: str) -> str:
    return f"n__{m}"


def sw_col(m: str) -> str:
    return f"sw__{m}"


def swx_col(m: str) -> str:
    return f"swx__{m}"


def stat_cols(metrics: list[str]) -> list[str]:
    out = []
    for m in metrics:
        out += [n_col(m), sw_col(m), swx_col(m)]
    return out


def metrics_of(df: DataFrame) -> list[str]:
    """Metric names carried by a cube DataFrame (from its ``n__`` columns)."""
    return [c[3:] for c in df.columns if c.startswith("n__")]


#: Cells whose sums a task holds before it gives them off: 20 kB each with 16 metrics and 81 weights.
HELD_CELLS = 4096
#: Cells given off in one Arrow batch.
BATCH_CELLS = 64
#: Rows whose weights are added at once: 26 MB with 81 weights.
BATCH_ROWS = 40_000


class CellSums:
    """Sums of one task over one list of keys: per cell the counts, and per metric the vectors over replicates."""

    def __init__(self, metrics: int, replicates: int):
        self.number: dict[tuple, int] = {}
        self.shape = metrics, replicates + 1
        self._grow(64)

    def _grow(self, size: int) -> None:
        old = len(self.number)
        n, sums = np.zeros((size, self.shape[0]), np.int64), np.zeros((size, 2, *self.shape))
        if old:
            n[:old], sums[:old] = self.n[:old], self.sums[:old]
        self.n, self.sums = n, sums

    def add(self, keys: list[pa.Array], weights: np.ndarray, values: np.ndarray, known: np.ndarray) -> None:
        """Rows by cell: weights (rows x replicates), values and known (metrics x rows)."""
        code = np.zeros(len(weights), dtype=np.int64)
        levels = []
        for k in keys:
            coded = k.dictionary_encode("encode")
            names = coded.dictionary.to_pylist()
            code = code * len(names) + coded.indices.to_numpy()
            levels.append(names)
        order = np.argsort(code, kind="stable")
        cells, starts = np.unique(code[order], return_index=True)
        ends = [*starts[1:].tolist(), len(order)]
        if len(self.number) + len(cells) > len(self.n):
            self._grow(2 * (len(self.number) + len(cells)))
        at = np.empty(len(cells), dtype=np.int64)
        for i, c in enumerate(cells.tolist()):
            cell = []
            for names in reversed(levels):
                c, place = divmod(c, len(names))
                cell.append(names[place])
            at[i] = self.number.setdefault(tuple(reversed(cell)), len(self.number))
        weights, ones = weights[order], known[:, order]
        self.n[at] += np.add.reduceat(ones.astype(np.int64), starts, axis=1).T
        # products of one shape, so both sums are the same additions in the same order: a mean of ones is exactly one
        ones, values = ones.astype(np.float64), values[:, order]
        for i, start, end in zip(at.tolist(), starts.tolist(), ends):
            part = weights[start:end]
            self.sums[i, 0] += ones[:, start:end] @ part
            self.sums[i, 1] += values[:, start:end] @ part

    def rows(self, schema: pa.Schema, names: list[str], number: int) -> Iterator[pa.RecordBatch]:
        """One row per cell and replicate; keys that are not among ``names`` are NULL."""
        cells = list(self.number)
        reps = self.shape[1]
        for at in range(0, len(cells), BATCH_CELLS):
            part = cells[at:at + BATCH_CELLS]
            size = len(part) * reps
            counts = np.repeat(self.n[at:at + len(part), None], reps, axis=1)
            sums = self.sums[at:at + len(part)]
            made = {"_set": pa.array(np.full(size, number, dtype=np.int32)),
                    "rep": pa.array(np.tile(np.arange(reps, dtype=np.int32), len(part)))}
            for name, values in zip(names, zip(*part)):
                made[name] = pa.array(values, type=schema.field(name).type).take(pa.array(np.repeat(np.arange(len(part)), reps)))
            stats = [c for c in schema.names if c.startswith("n__")]
            for m, c in enumerate(stats):
                made[c] = pa.array(counts[:, :, m].ravel())
                made[sw_col(c[3:])] = pa.array(sums[:, 0, m].ravel())
                made[swx_col(c[3:])] = pa.array(sums[:, 1, m].ravel())
            yield pa.RecordBatch.from_arrays(
                [made[f.name] if f.name in made else pa.nulls(size, f.type) for f in schema], schema=schema)


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``BATCH_ROWS`` rows or a little more: a cell is then added once for many rows."""
    held, rows = [], 0
    for rb in batches:
        held.append(rb)
        rows += rb.num_rows
        if rows >= BATCH_ROWS:
            yield pa.concat_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.concat_batches(held)


def task_sums(df: DataFrame, design: ReplicateDesign, metrics: list[str], keys: list[str],
              sets: list[list[str]]) -> DataFrame:
    """Each task's sums, by each of the lists of keys: (keys, _set, rep, stats), NULL in keys that are not of the
    list. Respondents without replicate weights are left out."""
    reps = design.n_replicates
    rows = df.select(*[F.col(k) for k in keys], F.col(design.weight).cast("double").alias("_w0"),
                     F.col(design.repweights).cast("array<double>").alias("_w"),
                     *[F.col(m).cast("double").alias(f"_x{i}") for i, m in enumerate(metrics)])
    rows = rows.where(F.col("_w").isNotNull())
    types = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType([*[T.StructField(k, types[k]) for k in keys], T.StructField("_set", T.IntegerType()),
                           T.StructField("rep", T.IntegerType()),
                           *[T.StructField(c, T.LongType() if c.startswith("n__") else T.DoubleType())
                             for c in stat_cols(metrics)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        held = [CellSums(len(metrics), reps) for _ in sets]
        first = len(keys) + 2
        for rb in joined(batches):
            flat = rb.column(first - 1).flatten()
            if len(flat) != rb.num_rows * reps:
                raise ValueError(f"every row needs {reps} replicate weights")
            weights = np.empty((rb.num_rows, reps + 1))
            weights[:, 0] = rb.column(first - 2).fill_null(0.0).to_numpy()
            weights[:, 1:] = flat.fill_null(0.0).to_numpy().reshape(-1, reps)
            weights *= design.weight_factor                                              # P36
            known = np.array([rb.column(first + m).is_valid().to_numpy(zero_copy_only=False) for m in range(len(metrics))])
            values = np.array([rb.column(first + m).fill_null(0.0).to_numpy() for m in range(len(metrics))])
            for i, (cells, names) in enumerate(zip(held, sets)):
                cells.add([rb.column(keys.index(k)) for k in names], weights, values, known)
                if len(cells.number) > HELD_CELLS:
                    yield from cells.rows(arrow, names, i)
                    held[i] = CellSums(len(metrics), reps)
        for i, (cells, names) in enumerate(zip(held, sets)):
            yield from cells.rows(arrow, names, i)

    return rows.mapInArrow(run, schema)


def sufficient_stats(df: DataFrame, design: ReplicateDesign, metrics: list[str],
                     keys: list[str]) -> DataFrame:
    """Cube at grain (keys, rep) with n/sw/swx per metric."""
    parts = task_sums(df, design, metrics, keys, [keys])
    return parts.groupBy(*keys, "rep").agg(*[F.sum(c).alias(c) for c in stat_cols(metrics)])


def geo_week_cube(df: DataFrame, design: ReplicateDesign, metrics: list[str],
                  state_col: str = "state", metro_col: str = "cbsa_title",
                  week_col: str = "week", race_col: str = "race") -> DataFrame:
    """Respondent rows -> (week, geo_type, geography, race, rep, stats).

    One scan for two lists of keys, (week, state, race) and (week, metro, race): the cube is
    bounded by states + metros, never by their product. Rows outside any listed metro form a
    NULL-geography metro bucket that only feeds complements.
    """
    rows = df.select(F.col(week_col).alias("week"), F.col(state_col).cast("string").alias("_state"),
                     F.col(metro_col).cast("string").alias("_metro"), F.col(race_col).alias("race"),
                     design.weight, design.repweights, *metrics)
    parts = task_sums(rows, design, metrics, ["week", "_state", "_metro", "race"],
                      [["week", "_state", "race"], ["week", "_metro", "race"]])
    is_state = F.col("_set") == 0
    parts = parts.select("week", F.when(is_state, "state").otherwise("msa").alias("geo_type"),
                         F.when(is_state, F.col("_state")).otherwise(F.col("_metro")).alias("geography"),
                         "race", "rep", *stat_cols(metrics))
    return rollup(parts, ["week", "geo_type", "geography", "race", "rep"], metrics)


def rollup(cube: DataFrame, keys: list[str], metrics: list[str] | None = None) -> DataFrame:
    """Merge cube rows to a coarser grain (sums of all statistics)."""
    metrics = metrics or metrics_of(cube)
    return cube.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in stat_cols(metrics)])


def to_intervals(cube: DataFrame, n_weeks: int, week_col: str = "week") -> DataFrame:
    """Week-grain cube -> interval-grain cube (each week feeds <= 2 intervals).

    Runs on the cube, not on respondent rows, so the fan-out costs nothing at
    scale.
    """
    metrics = metrics_of(cube)
    keys = [c for c in cube.columns if c not in stat_cols(metrics) and c != week_col]
    fan = cube.withColumn("interval_start", F.explode(interval_column(F.col(week_col), n_weeks)))
    out = rollup(fan, ["interval_start", *keys], metrics)
    return out.withColumn("week_num", interval_label(F.col("interval_start")))

"""By-hand replicate differences (A16, C7, C8), independent of the estimators.

Two means are taken by filtering: over a group's rows and over all others of the same
geography and interval, per replicate. The standard error is the survey's published
formula, sqrt(4 / 80 * sum over replicates of (difference - full-sample difference)^2). The
same is done for the group against the whole geography. Nothing here uses the cube, the
contrast, the variance or the complement code that it is held against.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repweave import constants as K
from repweave.functions.scalar import interval_label
from repweave.operators.intervals import rolling_fanout

KEYS = ["geo_type", "geography", "interval_start", "race_indicator", "metric"]
BY_HAND_FACTOR = 4.0 / K.N_REPLICATES


#: Cells that a task holds before it gives them off.
HELD = 4096
PLACES = {"state": "state", "msa": "cbsa_title", "national": None}


def _weights(first: pa.Array, others: pa.Array) -> tuple[np.ndarray, np.ndarray | None]:
    """(rows x replicates) weights, 0 where there is none, and where there is one (None: everywhere)."""
    lengths = others.value_lengths().to_numpy()
    flat = others.flatten()
    ends = np.cumsum(lengths)
    at = np.repeat(np.arange(len(lengths)), lengths), 1 + np.arange(len(flat)) - np.repeat(ends - lengths, lengths)
    shape = len(lengths), 1 + int(lengths.max())
    weights, there = np.zeros(shape), np.zeros(shape)
    weights[:, 0], there[:, 0] = first.fill_null(0.0).to_numpy(), first.is_valid().to_numpy(zero_copy_only=False)
    weights[at], there[at] = flat.fill_null(0.0).to_numpy(), flat.is_valid().to_numpy(zero_copy_only=False)
    return weights, None if there.all() else there


def _given_off(cells: dict, metrics: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row per cell and replicate; a sum over no rows is NULL."""
    for cell, sums in cells.items():
        size = sums.shape[2]
        out = [pa.array([v] * size, type=schema.field(i).type) for i, v in enumerate(cell)]
        out.append(pa.array(np.arange(size, dtype=np.int32)))
        for m in range(metrics):
            none = sums[1, m] == 0
            rows = np.zeros(size, dtype=np.int64)
            rows[0] = sums[0, m, 0]
            out += [pa.array(rows), pa.array(sums[2, m], mask=none), pa.array(sums[3, m], mask=none)]
        yield pa.RecordBatch.from_arrays(out, schema=schema)


def _cells(rows: DataFrame, time: str, metrics: list[str], weight: str, repweights: str) -> DataFrame:
    """Per place (state, metro, nation), ``time``, race and replicate the sums by filtering, each task's own first."""
    given = rows.select(time, "race", "state", "cbsa_title", F.col(weight).cast("double").alias("_w0"),
                        F.col(repweights).cast("array<double>").alias("_w"),
                        *[F.col(m).cast("double").alias(f"_x{i}") for i, m in enumerate(metrics)])
    given = given.where(F.col("_w").isNotNull())
    at = [T.StructField("geo_type", T.StringType()), T.StructField("geography", T.StringType()),
          given.schema[time], given.schema["race"], T.StructField("rep", T.IntegerType())]
    names = [f"{what}_{i}" for i in range(len(metrics)) for what in ("rows", "base", "hits")]
    schema = T.StructType([*at, *[T.StructField(c, T.LongType() if c.startswith("rows") else T.DoubleType()) for c in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        held: dict[tuple, np.ndarray] = {}
        for rb in batches:
            if not rb.num_rows:
                continue
            weights, there = _weights(rb.column("_w0"), rb.column("_w"))
            values = [rb.column(f"_x{i}") for i in range(len(metrics))]
            known = np.array([v.is_valid().to_numpy(zero_copy_only=False) for v in values]).astype(np.float64)
            values = np.array([v.fill_null(0.0).to_numpy() for v in values])
            frame = rb.select([time, "race", "state", "cbsa_title"]).to_pandas()
            for kind, place in PLACES.items():
                by = [time, "race"] if place is None else [time, "race", place]
                number = frame.groupby(by, dropna=False, sort=False).ngroup().to_numpy()
                order = np.argsort(number, kind="stable")
                for inside in np.split(order, np.flatnonzero(np.diff(number[order])) + 1):
                    first = int(inside[0])
                    cell = tuple(rb.column(c)[first].as_py() for c in by)
                    cell = (kind, "US" if place is None else cell[2], *cell[:2])
                    has, w = known[:, inside], weights[inside]
                    sums = np.empty((4, len(metrics), w.shape[1]))
                    sums[0] = has.sum(axis=1)[:, None]
                    sums[1] = sums[0] if there is None else has @ there[inside]
                    sums[2], sums[3] = has @ w, values[:, inside] @ w
                    old = held.get(cell)
                    if old is not None and old.shape != sums.shape:       # rows with more replicates than others
                        wide = max(old.shape[2], sums.shape[2])
                        old, sums = (np.pad(s, ((0, 0), (0, 0), (0, wide - s.shape[2]))) for s in (old, sums))
                    held[cell] = sums if old is None else old + sums
            if len(held) > HELD:
                yield from _given_off(held, len(metrics), arrow)
                held = {}
        yield from _given_off(held, len(metrics), arrow)

    parts = given.mapInArrow(run, schema).where("geography is not null")
    return parts.groupBy(*[f.name for f in at]).agg(*[F.sum(c).alias(c) for c in names])


def by_hand(rows: DataFrame, metrics: list[str] = K.METRICS, groups: list[str] = K.RACE_GROUPS,
            weight: str = "pweight", repweights: str = "repw", n_weeks: int | None = None) -> DataFrame:
    """Respondents fanned out to intervals -> per cell: hand_diff_mean, hand_diff_se,
    hand_total_mean (group against the geography's total) and hand_total_se. With ``n_weeks`` the
    respondents stand once, by ``week``, and their sums are fanned out."""
    if n_weeks is None:
        cells = _cells(rows, "interval_start", metrics, weight, repweights)
    else:
        cells = rolling_fanout(_cells(rows, "week", metrics, weight, repweights), n_weeks)
    stacked = cells.select("geo_type", "geography", F.col("interval_start").cast("int").alias("interval_start"), "race", "rep",
                           F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), *[
                               F.col(f"{what}_{i}").alias(what) for what in ("rows", "base", "hits")])
                               for i, m in enumerate(metrics)])))

    def filtered(inside: Column, what: str) -> Column:
        return F.sum(F.when(inside, F.col(what)))

    sides = []
    for g in groups:
        inside = F.coalesce(F.col("race") == g, F.lit(False))
        sides.append(F.struct(F.lit(g).alias("race_indicator"), *[
            filtered(side, what).alias(f"{name}_{what}") for name, side in (("in", inside), ("out", ~inside))
            for what in ("rows", "base", "hits")]))
    means = (stacked.groupBy("geo_type", "geography", "interval_start", "metric", "rep")
             .agg(F.array(*sides).alias("sides")).select("*", F.inline("sides")).drop("sides"))
    inside = F.try_divide("in_hits", "in_base")
    outside = F.try_divide("out_hits", "out_base")
    whole = F.try_divide(F.col("in_hits") + F.col("out_hits"), F.col("in_base") + F.col("out_base"))
    cell = Window.partitionBy(*KEYS)
    full = lambda c: F.max(F.when(F.col("rep") == 0, F.col(c))).over(cell)
    diffs = means.withColumns({"d": outside - inside, "t": whole - inside}).withColumns({"d0": full("d"), "t0": full("t")})
    se = lambda c: F.sqrt(F.lit(BY_HAND_FACTOR) * F.sum(F.when(F.col("rep") > 0, F.pow(F.col(c) - F.col(f"{c}0"), 2))))
    return (diffs.groupBy(*KEYS).agg(F.max("d0").alias("hand_diff_mean"), se("d").alias("hand_diff_se"),
                                     F.max("t0").alias("hand_total_mean"), se("t").alias("hand_total_se"))
            .withColumn("week_num", interval_label(F.col("interval_start"))))

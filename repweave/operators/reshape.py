"""Reshape, grid, padding, one-hot, group means and frame checks
(X1, X2, J6, U3, P35, A17, A18, O3, C9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repweave.functions.scalar import clean_name


def unpivot_metrics(df: DataFrame, ids: list[str], metrics: list[str],
                    drop_null: bool = True) -> DataFrame:
    """Wide metric columns -> (ids, metric, value)."""
    out = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics]) \
        .unpivot(ids, metrics, "metric", "value")
    return out.where(F.col("value").isNotNull()) if drop_null else out


def literal_grid(base: DataFrame, dims: dict[str, list]) -> DataFrame:
    """Every row of ``base`` (a small distinct key table) times the literal
    value lists in ``dims``; built with ``explode``, not a cross join."""
    out = base
    for name, values in dims.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out


def pad_missing(grid: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Add NULL-valued rows for grid cells absent from ``present``
    (anti-join + union by name)."""
    missing = grid.join(present.select(*keys), keys, "left_anti")
    return present.unionByName(missing, allowMissingColumns=True)


def one_hot_names(levels: list, prefix: str) -> dict:
    """Column name per level: cleaned, and numbered _2, _3, ... where cleaned names clash.
    ``{prefix}_na`` belongs to NULL alone."""
    taken, names = {f"{prefix}_na"}, {}
    for v in sorted((x for x in levels if x is not None), key=lambda x: (str(x), repr(x))):
        base = name = f"{prefix}_{clean_name(str(v))}"
        k = 1
        while name in taken:
            k += 1
            name = f"{base}_{k}"
        taken.add(name)
        names[v] = name
    if None in levels:
        names[None] = f"{prefix}_na"
    return names


def one_hot(df: DataFrame, col: str, levels: list | None = None, prefix: str | None = None) -> DataFrame:
    """One 0/1 column per distinct value of ``col`` (names cleaned, clashes numbered).

    NULL gets its own ``{col}_na`` column and 0 in every other dummy, so
    'not in this category' always includes NULL rows. Without ``levels`` the distinct
    values are taken from the data: as many as the result has columns.
    """
    if levels is None:
        levels = [r[0] for r in df.select(col).distinct().collect()]
    return df.withColumns({
        name: F.when(F.col(col).isNull() if v is None else F.col(col) == F.lit(v), 1).otherwise(0)
        for v, name in one_hot_names(levels, prefix or clean_name(col)).items()})


def mean_strict(col: str) -> Column:
    """R ``mean`` without na.rm: NULL as soon as one input is NULL."""
    return F.when(F.count(col) == F.count(F.lit(1)), F.avg(col))


def group_mean(df: DataFrame, keys: list[str], col: str, na_rm: bool = False) -> DataFrame:
    """Mean of ``col`` per group (strict NULL semantics unless na_rm)."""
    m = F.avg(col) if na_rm else mean_strict(col)
    return df.groupBy(*keys).agg(m.alias("mean"), F.count(F.lit(1)).alias("n"))


def ratio_of_sums(df: DataFrame, keys: list[str], num: Column, den: Column) -> DataFrame:
    """sum(num) / sum(den) per group, NULL on a zero denominator."""
    g = df.groupBy(*keys).agg(F.sum(num).alias("sum_num"), F.sum(den).alias("sum_den"))
    return g.withColumn("ratio", F.try_divide(F.col("sum_num"), F.col("sum_den")))


def sample_rows(df: DataFrame, n: int, seed: int, key_cols: list[str]) -> DataFrame:
    """O3: a seeded, reproducible sample of n rows: the first n by the MD5 of seed and keys."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c) for c in key_cols]))
    return df.withColumn("_h", h).orderBy("_h", *key_cols).limit(n).drop("_h")


def sample_with_replacement(df: DataFrame, n: int, seed: int, key_cols: list[str], bucket_rows: int = 100_000) -> DataFrame:
    """O3: n draws with replacement: the rows drawn, with their ``multiplicity``; these sum to exactly n.

    Draw d takes the row whose place is a hash of seed and d, modulo the number of rows; a row's place is
    its rank by the MD5 of seed and keys. Ranks come from the counts of hash ranges (one pass) and the rank
    inside a range, so the table is never sorted as a whole, and only ranges with a draw are ranked. The
    result does not depend on the partitioning. An empty table gives no rows.
    """
    spark = df.sparkSession
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c) for c in key_cols]))
    total = df.count()
    if total == 0:
        return df.withColumn("multiplicity", F.lit(0).cast("bigint")).limit(0)
    buckets = max(1, -(-total // bucket_rows))
    # hash ranges in order: the first 32 bits, scaled
    bucket = F.floor(F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") * F.lit(buckets) / F.lit(1 << 32)).cast("int")
    hashed = df.withColumn("_h", h).withColumn("_b", bucket)
    sizes = {r["_b"]: r["count"] for r in hashed.groupBy("_b").count().collect()}
    ranges, at = [], 0
    for b in sorted(sizes):
        ranges.append((b, at, at + sizes[b]))
        at += sizes[b]
    place = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("draw"), F.col("id"))), 1, 12), 16, 10).cast("bigint")
    draws = spark.range(1, n + 1).select((place % F.lit(total)).alias("_place")).groupBy("_place").agg(
        F.count(F.lit(1)).alias("multiplicity"))
    # a place finds its range over cells of equal width: a range lies in few of them
    cell = lambda c: F.floor(F.col(c) / F.lit(bucket_rows))
    bounds = spark.createDataFrame(ranges, "_b int, _from bigint, _to bigint").withColumn(
        "_cell", F.explode(F.sequence(cell("_from"), F.floor((F.col("_to") - 1) / F.lit(bucket_rows)))))
    drawn = draws.withColumn("_cell", cell("_place")).join(bounds, "_cell").where(
        (F.col("_place") >= F.col("_from")) & (F.col("_place") < F.col("_to")))
    drawn = drawn.select("_b", (F.col("_place") - F.col("_from") + 1).alias("_rank"), "multiplicity")
    hit = hashed.join(drawn.select("_b").distinct(), "_b", "left_semi")
    ranked = hit.withColumn("_rank", F.row_number().over(Window.partitionBy("_b").orderBy("_h", *key_cols)))
    return ranked.join(drawn, ["_b", "_rank"]).select(*df.columns, "multiplicity")


def bucket_digests(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """(bucket, rows, digest): order-free digests of all columns, per bucket of the keys' hash."""
    return _dealt(df, keys, buckets).groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")).alias("digest"))


def _dealt(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumn("_bucket", F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int"))


def frame_diff_by_digest(a: DataFrame, b: DataFrame, keys: list[str], tol: float = 1.5e-8, buckets: int = 4096) -> DataFrame:
    """C9 for large outputs: ``frame_diff``, where only the rows of buckets whose digests differ are joined. Equal
    frames shuffle at most ``buckets`` digests per task, and no row. Columns are those of ``a``."""
    b = b.select(*a.columns)
    da = bucket_digests(a, keys, buckets)
    db = bucket_digests(b, keys, buckets).select(F.col("_bucket").alias("_other"), F.col("rows").alias("r2"), F.col("digest").alias("d2"))
    apart = da.join(db, F.col("_bucket") == F.col("_other"), "full").where(
        ~(F.col("rows").eqNullSafe(F.col("r2")) & F.col("digest").eqNullSafe(F.col("d2"))))
    # at most one number per bucket
    numbers = [r[0] for r in apart.select(F.coalesce("_bucket", "_other")).collect()]
    only = lambda df: _dealt(df, keys, buckets).where(F.col("_bucket").isin(numbers)).drop("_bucket")
    return frame_diff(only(a), only(b), keys, tol) if numbers else frame_diff(a.limit(0), b.limit(0), keys, tol)


def frame_diff(a: DataFrame, b: DataFrame, keys: list[str], tol: float = 1.5e-8) -> DataFrame:
    """Keyed comparison of two frames (empty = equal).

    A row is reported when its key is on one side only, or when any other
    column differs: doubles beyond ``tol`` (relative to the larger magnitude,
    absolute below 1), other types by NULL-safe equality.
    """
    vals = [c for c in a.columns if c not in keys]
    la = a.select(*[F.col(k).alias("lk_" + k) for k in keys],
                  *[F.col(c).alias("l_" + c) for c in vals], F.lit(True).alias("_l"))
    rb = b.select(*[F.col(k).alias("rk_" + k) for k in keys],
                  *[F.col(c).alias("r_" + c) for c in vals], F.lit(True).alias("_r"))
    cond = None
    for k in keys:                      # NULL keys (e.g. the no-metro bucket) match NULL
        c = F.col("lk_" + k).eqNullSafe(F.col("rk_" + k))
        cond = c if cond is None else cond & c
    j = la.join(rb, cond, "full").select(
        *[F.coalesce(F.col("lk_" + k), F.col("rk_" + k)).alias(k) for k in keys], "*")
    types = {f.name: f.dataType.typeName() for f in a.schema.fields}
    bad = F.col("_l").isNull() | F.col("_r").isNull()
    for c in vals:
        l, r = F.col("l_" + c), F.col("r_" + c)
        if types[c] == "double":
            scale = F.greatest(F.abs(l), F.abs(r), F.lit(1.0))
            diff = (l.isNull() != r.isNull()) | (F.abs(l - r) > F.lit(tol) * scale)
        else:
            diff = ~l.eqNullSafe(r)
        bad = bad | F.coalesce(diff, F.lit(False))
    side = (F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only")
            .otherwise("both"))
    return j.where(bad).select(*keys, side.alias("side"))

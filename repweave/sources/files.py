"""File sources.

Weekly files carry their week in their path. They are bound by header name, never by
position: files are grouped by their header line (one short read per file), each group is
scanned with its own column list, and the groups are stacked by name, so a column that
early weeks lack is NULL there wherever it stands in later files. A name that is not known
is an error, not a silent extra. All values are read as text; nothing is inferred.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repweave.functions.scalar import clean_name, extract_or_null, str_pad_left

WEEK_IN_PATH = r"(?:week=|_)(\d+)(?:/[^/]*|\.[a-z]+)$"


def week_file_name(prefix: str, week: Column) -> Column:
    """S1 + E2: file name with a two-digit week (longer numbers are kept whole)."""
    return F.concat(F.lit(prefix + "_"), str_pad_left(week.cast("string"), 2), F.lit(".csv"))


def week_from_path(pattern: str = WEEK_IN_PATH) -> Column:
    """Week number parsed from the path of each row's source file."""
    return extract_or_null(F.col("_metadata.file_path"), pattern).cast("int")


def list_files(spark: SparkSession, path: str, suffix: str = ".csv") -> list[str]:
    """All files below a folder (or the file itself) whose name ends in ``suffix``."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
    out = []
    while found.hasNext():
        name = found.next().getPath().toString()
        if name.endswith(suffix):
            out.append(name)
    return sorted(out)


def header_of(spark: SparkSession, file: str) -> tuple[str, ...]:
    """The names in a file's first line; only that line is read."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return tuple(next(csv.reader([line]))) if line else ()


def clean_header(names: tuple[str, ...]) -> list[str]:
    """P1 on a header: cleaned names, clashes numbered _2, _3."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        base = clean_name(n)
        seen[base] = seen.get(base, 0) + 1
        out.append(base if seen[base] == 1 else f"{base}_{seen[base]}")
    return out


def read_weekly_csv(spark: SparkSession, path: str, columns: list[str], week_col: str = "week") -> DataFrame:
    """Every weekly CSV below ``path``, columns bound by cleaned header name.

    ``columns`` are the known names; the result has exactly these, as text, and the week of
    the path unless the file has one. Files without a header line hold no rows."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for file in list_files(spark, path):
        names = tuple(clean_header(header_of(spark, file)))
        if names:
            groups.setdefault(names, []).append(file)
    out = None
    for names, files in sorted(groups.items()):
        unknown = sorted(set(names) - {*columns, week_col})
        if unknown:
            raise ValueError(f"unknown columns {unknown} in {files[0]}")
        schema = ", ".join(f"`{n}` string" for n in names)
        df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(files)
        week = week_from_path()
        if week_col in names:
            week = F.coalesce(F.col(week_col).cast("int"), week)
        df = df.select(week.alias(week_col), *[n for n in names if n != week_col])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        out = spark.createDataFrame([], f"`{week_col}` int")
    have = set(out.columns)
    return out.select(week_col, *[F.col(c) if c in have else F.lit(None).cast("string").alias(c)
                                  for c in columns if c != week_col])


def coerce_numeric(df: DataFrame, cols: list[str], to: str = "double") -> DataFrame:
    """Text -> number; unparseable values become NULL (``try_cast``),
    where an ANSI ``cast`` would fail the job."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` as {to})") for c in cols})

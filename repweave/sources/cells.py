"""Headerless cell files with title rows to skip.

A published table is a text file of comma-separated cells: title lines, then rows that say by position and
width what they are. Lines are numbered inside each file in a splittable read: a task numbers the lines of
its blocks, one small row per block (file, start, lines) gives the lines that stand before it, and
the two are added. No file is read whole by one task and nothing is sorted but the blocks.
A quoted cell may hold commas and doubled quotes, not line ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repweave.operators.joins import bounded_broadcast

_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, folder columns, path, line): the lines of all text files below a path, numbered from 1 per file."""
    lines = spark.read.text(path)
    lines = lines.select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"),
                         F.monotonically_increasing_id().alias("_id"))
    # ids rise by one along a block
    blocks = lines.groupBy("path", "_start").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("path", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    out = lines.join(bounded_broadcast(blocks), ["path", "_start"])
    keep = [c for c in lines.columns if c not in ("path", "_start", "_id")]
    return out.select(*keep, "path", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line"))


def cells_of(value: Column) -> Column:
    """The cells of a line; an empty unquoted cell is NULL."""
    def plain(x: Column) -> Column:
        quoted = x.rlike(r'^\s*".*"\s*$')
        inner = F.replace(F.regexp_extract(x, r'^\s*"(.*)"\s*$', 1), F.lit('""'), F.lit('"'))
        return F.when(quoted, inner).when(F.trim(x) != "", F.trim(x))
    return F.transform(F.split(value, _COMMA), plain)


def line_of(cells: list[Column]) -> Column:
    """A line of cells, each quoted where it has to be; NULL is an empty cell."""
    written = []
    for c in cells:
        text = c.cast("string")
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        written.append(F.coalesce(F.when(text.rlike('[",]|^\\s|\\s$|^$'), quoted).otherwise(text), F.lit("")))
    return F.concat_ws(",", *written)


def read_cells(spark: SparkSession, path: str, skip: int) -> DataFrame:
    """(folder columns, path, line, cells) of the rows behind the first ``skip`` lines of each file."""
    rows = numbered_lines(spark, path).where(F.col("line") > skip)
    return rows.withColumn("cells", cells_of(F.col("value"))).drop("value")


def write_cell_files(rows: DataFrame, path: str, folders: list[str], order: str, line: Column, titles: list[str]) -> None:
    """One text file per value of ``folders``: the title lines, then a line per row by ``order``."""
    body = rows.select(*folders, F.lit(1).alias("_part"), F.col(order).cast("long").alias("_at"), line.alias("value"))
    heads = rows.select(*folders).distinct().select(
        *folders, F.lit(0).alias("_part"), F.posexplode(F.array(*[F.lit(t) for t in titles])).alias("_pos", "value"))
    heads = heads.select(*folders, "_part", F.col("_pos").cast("long").alias("_at"), "value")
    (heads.unionByName(body).repartition(*folders).sortWithinPartitions(*folders, "_part", "_at")
     .select(*folders, "value").write.partitionBy(*folders).text(path))

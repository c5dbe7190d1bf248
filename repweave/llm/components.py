"""Connected components of a link table by alternating large-star and small-star steps.

Each step is a grouped minimum and a join back on the same key, so it shuffles links, never
groups; Spark splits a skewed join key (the centre of a large group). Every round's links are
written to the shared folder, which cuts the lineage. Rounds grow with the logarithm of the
longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repweave.llm.common import materialise


def _digest(links: DataFrame) -> tuple:
    # order-free: the count and a wrapped sum of hashes
    row = links.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(links: DataFrame) -> DataFrame:
    """From links (u, v) of longs to (u, v): every node u that is linked to anything, with
    v the smallest node it can reach; the smallest node itself is left out."""
    now = materialise(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .distinct(), "links")
    before = _digest(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialise(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        after = _digest(now)
        if after == before:
            break
        before = after
    return now

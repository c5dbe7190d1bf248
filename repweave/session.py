"""Session construction and shared-storage settings."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins/partition counts from runtime
# statistics; the UI is off because nothing here may open a port beyond Spark's own.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


JIT_OPTS = "-XX:-DontCompileHugeMethods"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "repweave") -> SparkSession:
    """Return the active session, or build a local one for tests and benches.

    On a cluster the session already exists (spark-submit); only the SQL
    settings above are applied to it.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        for k, v in DEFAULT_CONF.items():
            if k.startswith("spark.sql."):
                active.conf.set(k, v)
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (SparkSession.builder
               .master(master or f"local[{cpus}]")
               .appName(app_name)
               .config("spark.driver.memory", os.environ.get("REPWEAVE_DRIVER_MEMORY", "8g"))
               # wide generated methods (recodes, replicate sums) must still be
               # JIT-compiled; HotSpot skips methods over 8000 bytecodes otherwise
               .config("spark.driver.extraJavaOptions", os.environ.get("REPWEAVE_JIT", JIT_OPTS))
               .config("spark.executor.extraJavaOptions", os.environ.get("REPWEAVE_JIT", JIT_OPTS))
               .config("spark.sql.shuffle.partitions",
                       str(shuffle_partitions or int(cpus))))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def compile_wide_stages(spark: SparkSession) -> None:
    """The projections of recodes and weights make methods of over 8000 bytecodes, which HotSpot interprets, row by
    row, unless the JVM was started with ``JIT_OPTS``. Under this limit Spark generates them operator by operator, in
    small methods. It is a setting of plans alone, so it also serves a session that the caller has made."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", DEFAULT_CONF["spark.sql.codegen.hugeMethodLimit"])


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a stage folder in whatever file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` as the cluster configures it. When it is unset, a
    local session gets a fresh scratch folder; any other master raises, because its
    executors would each write to a disk of their own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    local = tempfile.mkdtemp(prefix="repweave-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(local)
    return local

"""Session construction and cluster-facing settings.

Library functions never create a session themselves; they take the caller's
``SparkSession``. ``build_session`` is for scripts, tests and the bench.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on. AQE re-plans joins (runtime, size-checked
# broadcast), coalesces small shuffle partitions and splits skewed join
# partitions; the session time zone only matters for LTZ timestamps, which the
# library builds from UTC epoch values so results do not depend on it.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "trendlens", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the library defaults.

    ``master`` is set only when given. Without it a launcher's master
    (``spark-submit``, ``SPARK_MASTER`` or Spark's defaults) is kept; only a
    plain Python process with no master at all gets ``local[$BENCH_CPUS or 8]``.
    Shuffle partitions keep Spark's default unless given or the master is local.
    """
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.appName(app_name)
    master = master or os.environ.get("SPARK_MASTER")
    launched = "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "") or "PYSPARK_GATEWAY_PORT" in os.environ
    if not master and not launched:
        master = f"local[{cpus}]"
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions or (master or "").startswith("local"):
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or max(cpus, 8))
    if (master or "").startswith("local"):
        conf["spark.driver.memory"] = os.environ.get("TRENDLENS_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


class NoSharedFolder(RuntimeError):
    """No folder that the driver and every executor share is configured."""


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir`` (or the one the
    application set on its context). With none, only a local master, where all
    tasks share this machine's disk, gets a folder of its own below the
    warehouse; on a cluster that would scatter the files, so it is an error.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/trendlens-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for ``name`` below this application's part of the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage without tying rows to an executor, and gives the planner a
    measured size for the table. ``release_scratch`` deletes it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete every intermediate table of this application.

    DataFrames built on them must have been written or collected before.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)

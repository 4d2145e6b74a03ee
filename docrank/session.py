"""Session helpers: a local session for tests and benches, and the shared
folder used to cut lineage.

Library functions never change session settings; they take the session the
caller already built. Only ``local_session`` (tests, bench, examples) sets
configuration, and ``checkpoint_dir`` sets a folder only when the cluster has
not named one.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The query side and the term dictionary of a small corpus fit easily;
    # AQE only broadcasts a side after measuring it at run time.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "docrank") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name one on a file system that all executors share; without
    it this raises, because a local folder would scatter the files over the
    executors' disks. Only a session on a ``local`` master gets a fresh folder
    under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="docrank-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written intermediates."""
    return checkpoint_dir(spark).rstrip("/") + "/" + name


# Whether a statement's shuffle files go when it ends; else they stay until the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", **options: str) -> None:
    """Write ``df`` to ``path``, compressed well, and free the shuffles that it took. ``options``: of the writer, ``__`` for dots."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.options(**{k.replace("__", "."): v for k, v in options.items()}).parquet(path, mode=mode, compression="zstd")
    finally:
        conf.unset(SHUFFLE_CLEANUP) if before is None else conf.set(SHUFFLE_CLEANUP, before)

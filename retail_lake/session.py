"""Spark session helpers.

Everything here is plain Spark configuration: AQE on (runtime coalescing,
skew-join splitting, runtime broadcast decisions from real sizes), UI off,
UTC session time zone, ANSI on (Spark 4 default).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SCALE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Shuffle partitions sized for the bench host; on a cluster set this to
    # (shuffle bytes / ~128 MB) and let AQE coalesce downwards.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.exchange.reuse": "true",
    "spark.sql.execution.reuseSubquery": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "retail_lake", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder the cluster names.

    A cluster sets ``spark.checkpoint.dir`` to a shared (HDFS/object store)
    folder; we only read it. Only when it is unset (local tests) do we point it
    at a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = fallback or tempfile.mkdtemp(prefix="rl-ckpt-")   # local runs and tests only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured

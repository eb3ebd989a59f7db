"""Write an intermediate result once and continue from the written copy."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from retail_lake.session import ensure_checkpoint_dir


_BLOCK: ContextVar[list[str] | None] = ContextVar("staged", default=None)


#: Files a task keeps open at once when it writes a table in folders; rows of further folders are sorted first.
OPEN_FOLDERS = 16


@contextmanager
def folders_unsorted(spark: SparkSession) -> Iterator[None]:
    """Inside the block a write in few folders keeps a file open for each, instead of sorting all rows of a task
    by folder first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(OPEN_FOLDERS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside the block a write removes its own shuffle files when it has ended; else they stay on the executors'
    disks until the driver collects its garbage, and those of several writes add up."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextmanager
def staged_for_block(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside the block at its end; results must be written by then."""
    paths: list[str] = []
    token = _BLOCK.set(paths)
    try:
        yield
    finally:
        _BLOCK.reset(token)
        sc = spark.sparkContext
        for p in paths:
            path = sc._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Materialise ``df`` as parquet under the shared checkpoint folder.

    Used where one aggregate feeds several branches (main rows, value counts,
    boundary subqueries): it is computed once, lineage is cut (a lost executor
    re-reads the files instead of recomputing the fact scan), and the
    branches start from a small columnar scan with real size statistics.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/retail_lake/stages/{label}-{uuid.uuid4().hex}"
    if (block := _BLOCK.get()) is not None:
        block.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

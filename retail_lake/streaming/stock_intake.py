"""Stock files arriving in a landing folder -> append-only stock history.

The reference re-seeds its stock file on a 6-hour schedule and keeps no
history. Here each arriving stock CSV is one load: a file-source stream with
the declared raw schema picks up new files, and ``foreachBatch`` runs the
bronze stock model on the batch, stamps it with the load time and writes it
to the history table as a partition of its own, named after the stream's
checkpoint and the batch number. Batches therefore never share a partition,
however many files a folder holds and whatever their load time, and a batch
that is replayed after a crash replaces the partition it wrote before. The
stream checkpoint (under the shared checkpoint folder) records which files
were taken, so a restarted run neither skips nor repeats a file. ``availableNow`` processes everything
present and stops, which fits a scheduled run; a continuous trigger works too.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake.plans.bronze import stg_stock_levels
from retail_lake.schemas import RAW_STOCK_LEVELS
from retail_lake.session import ensure_checkpoint_dir
from retail_lake.sources.sinks import CatalogSink

HISTORY_TABLE = "stg_stock_history"


def stock_file_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    return (spark.readStream.schema(RAW_STOCK_LEVELS)
                 .option("header", True)
                 .option("maxFilesPerTrigger", max_files_per_trigger)
                 .option("recursiveFileLookup", True)      # each load may land in its own folder
                 .csv(landing_dir))


def ingest_stock_files(spark: SparkSession, landing_dir: str, sink: CatalogSink,
                       load_time: dt.datetime | None = None, checkpoint: str | None = None,
                       available_now: bool = True):
    """Start (and, with ``available_now``, finish) the intake stream.

    Each micro-batch is one load (``load_id``: stream and batch number), its
    rows stamped with ``load_time`` (default: the batch's processing time).
    """
    checkpoint = checkpoint or ensure_checkpoint_dir(spark).rstrip("/") + "/streams/stock_intake"

    stream = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        stamp = load_time or dt.datetime.now().replace(microsecond=0)
        staged = stg_stock_levels(batch, stamp).withColumn("load_id", F.lit(f"{stream}-{batch_id:09d}"))
        sink.append_partition(HISTORY_TABLE, staged, "load_id")

    writer = stock_file_stream(spark, landing_dir).writeStream.foreachBatch(load_batch) \
        .option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="6 hours")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query

"""Commit records: which models of a run are built, so that a later attempt goes on at the first one without a record.

A run is known by its parameters, its variants and the files it reads. Those are digested by a Spark job over
the file listing (path, length, time of change; no content is read), so a changed, added or removed input
file makes another run. A record is appended after the model's table is whole and counted: a model that
was stopped half-way has none and is built anew under another version. A record whose table is gone does not
count. Inputs without files behind them (frames made in the session) cannot be known again, nor can a run that
starts above bronze, since it reads what other runs published: they leave no records and every attempt builds all.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from retail_lake.params import RunParams
from retail_lake.sources.sinks import CatalogSink

COMMIT_SCHEMA = ("run_key string, layer string, model string, table_name string, row_count bigint, "
                 "committed_at timestamp_ntz")


def files_digest(inputs: list[DataFrame]) -> str | None:
    """Digest of the files behind the inputs; None if an input has none."""
    found = [df.inputFiles() for df in inputs]
    if not found or not all(found):
        return None
    paths = sorted({re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(p)) for files in found for p in files})
    listing = inputs[0].sparkSession.read.format("binaryFile").load(paths)
    one = listing.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"),
                      F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("digest")).first()
    return f"{one.n}-{one.bytes}-{one.digest}"


def run_key(inputs: list[DataFrame], params: RunParams, corrected: bool, fmt: str) -> str | None:
    files = files_digest(inputs)
    return files and hashlib.sha256(repr((files, params, corrected, fmt)).encode()).hexdigest()


class Commits:
    """Records of one run in ``ops.model_commits``; without a key nothing is found and nothing recorded."""

    def __init__(self, sink: CatalogSink, key: str | None):
        self.sink, self.key = sink, key
        self.built: dict[str, Row] = {}
        if key and sink.exists("model_commits"):
            mine = sink.table("model_commits").where(F.col("run_key") == key).orderBy("committed_at")
            self.built = {r.model: r for r in mine.collect()}       # a run's models, once for each attempt

    def find(self, model: str) -> Row | None:
        record = self.built.get(model)
        return record if record is not None and self.sink.spark.catalog.tableExists(record.table_name) else None

    def add(self, layer: str, model: str, table: str, rows: int) -> None:
        if self.key:
            self.sink.append("model_commits", self.sink.spark.createDataFrame(
                [(self.key, layer, model, table, rows, dt.datetime.now())], COMMIT_SCHEMA))

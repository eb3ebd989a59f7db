"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words of the ASCII-case-folded word form
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: everything but digits, letters and non-ASCII.
_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLD = bytes(range(256)).lower()
WORD_BYTES = bytes(b if b in _KEPT else 0x20 for b in _FOLD)


_SHIPPED: set[str] = set()
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def ship_package(spark: SparkSession) -> None:
    """Make a session ready for Python workers.

    Arrow batches are held to BATCH_ROWS and BATCH_BYTES, so that a worker's
    memory does not follow the length of texts, and this package's code is
    sent to the executors once per application (as ``--py-files`` would).
    """
    conf, sc = spark.conf, spark.sparkContext
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="py-files-"), f"{os.path.basename(package)}_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(package):
            for f in sorted(files):
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def words(text: str) -> list[bytes]:
    """Words of the whole text as UTF-8 bytes, A-Z lower-cased (see WORD_BYTES)."""
    return text.encode("utf-8", "replace").translate(WORD_BYTES).split()


def fold_ascii(col: Column) -> Column:
    """Lower-case A-Z only, as a native expression."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Remembered(dict):
    """key -> make(key), kept in two generations so that frequent keys outlive rare ones.

    Bounds the memory of a worker; what is forgotten is made again.
    """

    def __init__(self, make: Callable, size: int, longest: int = 64):
        super().__init__()
        self.make, self.size, self.longest, self.old = make, size, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


_BEFORE_OR_AFTER = re.compile(r"\s | \s")
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def spaced_runs(text: str) -> list[str]:
    """Cut a text at single spaces between non-space characters.

    Every run but the first stands for itself with the space before it. The
    tokenizers' patterns attach a space to what follows it and never look
    across such a cut, so runs can be split into pieces one by one.
    """
    if _BEFORE_OR_AFTER.search(text) is None and not text.startswith(" ") and not text.endswith(" "):
        return text.split(" ")
    return _SINGLE_SPACE.split(text)

"""Training corpus pipeline: language ID, SimHash dedup, decontamination, byte-level BPE.

Every stage takes what the one before kept, as written and reread Parquet.
All but the last return the columns of ``documents``; the last adds the ids.
Documents without an identified language, all but the smallest id of each
near-duplicate group, and documents that hold a benchmark item leave.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retail_lake.llm.bpe import Tokenizer
from retail_lake.llm.common import table
from retail_lake.llm.decontaminate import keep_clean
from retail_lake.llm.langid import keep_identified
from retail_lake.llm.simhash import keep_one_of_each
from retail_lake.operators.stages import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return Tokenizer(spark).encode(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode_tokens),
]

#: Fingerprints, components and the learned language model are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

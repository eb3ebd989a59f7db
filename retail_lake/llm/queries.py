"""Registered queries of the training-data operators and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from retail_lake.llm import (
    ann, bpe, chat, decontaminate, filteraudit, hilbert, langid, licenses, simhash, spelling, tokencount, toxicity,
    urlfilter,
)
from retail_lake.llm.common import table


def _on(function: Callable[..., DataFrame], *names: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: function(*[table(spark, sf_dir, n) for n in names])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": lambda spark, sf_dir: bpe.encoded_digests(spark, table(spark, sf_dir, "documents")),
    "op2_language_id": _on(langid.predicted_languages, "documents"),
    "op3_decontamination": _on(decontaminate.contaminations, "documents", "benchmark"),
    "op4_license_scan": _on(licenses.scan_licenses, "documents"),
    "op5_simhash": _on(simhash.document_components, "documents"),
    "op6_chat_format": _on(chat.formatted_digests, "conversations"),
    "op7_url_filter": _on(urlfilter.judge_urls, "pages", "labels"),
    "op8_neighbours": _on(ann.embedding_neighbours, "embeddings"),
    "op9_hilbert_shards": _on(hilbert.shard_documents, "documents"),
    "op10_token_counts": lambda spark, sf_dir: tokencount.count_tokens(spark, table(spark, sf_dir, "documents")),
    "op11_toxicity": _on(toxicity.toxic_documents, "documents", "labels"),
    "op12_spelling_variants": _on(spelling.spelling_variants, "documents"),
    "op13_filter_audit": _on(filteraudit.audit_filters, "documents", "labels"),
}

ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": decontaminate.ORACLE_SQL,
    "op6_chat_format": chat.ORACLE_SQL,
    "op7_url_filter": urlfilter.ORACLE_SQL,
    "op13_filter_audit": filteraudit.ORACLE_SQL,
}

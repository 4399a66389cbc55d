"""Registered queries of the training-text operators and the SQL of those that have any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import (
    q_chat,
    q_decontam,
    q_html,
    q_ngram,
    q_packing,
    q_pii,
    q_quality,
    q_resample,
    q_shards,
    q_topk,
    q_trie,
    q_url,
    q_warc,
)

GROUPS = [q_chat, q_decontam, q_html, q_ngram, q_packing, q_pii, q_quality, q_resample, q_shards, q_topk, q_trie, q_url, q_warc]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for g in GROUPS for name, fn in g.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for g in GROUPS for name, sql in g.ORACLE.items()}

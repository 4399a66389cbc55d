"""op5: documents alike by 4-word shingles at a Jaccard similarity of 0.85."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import ngram_join
from kerbside.llm.tables import table


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.similar_groups(docs, words=4, num=85, den=100)


QUERIES = {"op5_ngram_jaccard": op5_ngram_jaccard}
ORACLE: dict[str, str] = {}

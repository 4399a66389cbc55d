"""op2: all documents packed into sequences of 4096 tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import packing
from kerbside.llm.tables import table

VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = packing.pack_documents(docs, vocabulary_path())
    return done.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {"op2_best_fit_packing": op2_best_fit_packing}
ORACLE: dict[str, str] = {}

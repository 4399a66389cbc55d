"""op11: all documents in 24 shards of nearly equal bytes, cut along source, language and id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import kd_shards
from kerbside.llm.tables import table

SHARDS = 24
DIMENSIONS = ["source", "lang", "doc_id"]


def op11_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return kd_shards.kd_shards(docs, SHARDS, DIMENSIONS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


QUERIES = {"op11_kd_sharding": op11_kd_sharding}
ORACLE: dict[str, str] = {}

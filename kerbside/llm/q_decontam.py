"""op10: benchmark windows in every whole document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import decontam
from kerbside.llm.tables import table


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda acc, h: acc + h["last"] - h["first"] + 1)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


QUERIES = {"op10_decontaminate": op10_decontaminate}
ORACLE: dict[str, str] = {}

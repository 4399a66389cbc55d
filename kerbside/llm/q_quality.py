"""op3: a quality score for every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import quality
from kerbside.llm.tables import table


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    machine = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    # The text is read by the scorer and goes no further.
    done = quality.scored(docs.select("doc_id", "text", "n_chars"), machine, keep=["doc_id"])
    return done.select(
        "doc_id", quality.held_out().alias("held_out"), "score",
        F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


QUERIES = {"op3_quality": op3_quality}
ORACLE: dict[str, str] = {}

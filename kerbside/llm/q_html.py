"""op1: main text of every page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import html_text
from kerbside.llm.tables import table


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    done = html_text.extract_main_text(pages)
    return done.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


QUERIES = {"op1_html_text": op1_html_text}
ORACLE: dict[str, str] = {}

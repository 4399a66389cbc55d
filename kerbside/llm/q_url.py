"""op4: every page's URL judged by fixed rules, then by rules mined from the labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import url_rules
from kerbside.llm.tables import table

RULES = [
    url_rules.Rule("org/", "allow"), url_rules.Rule("example.org/es/", "block"), url_rules.Rule("example.org/en/1", "block"),
    url_rules.Rule("com/fr/", "allow"), url_rules.Rule("com/de/", "block"),
]


def labelled_urls(spark: SparkSession, sf_dir: str, pages: DataFrame) -> DataFrame:
    """A page shows the document whose number ends its path; its label is that document's."""
    number = F.regexp_extract("path", r"/([0-9]{1,18})(?:[./]|$)", 1)
    shown = pages.withColumn("doc_id", F.when(number != "", number.cast("long")))
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max((F.coalesce("quality", F.lit(1)) == 0).cast("int")).alias("low"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    bad = (F.col("low") == 1) | (F.col("toxic") == 1)
    return shown.join(labels, "doc_id").select("tokens", bad.alias("bad"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = url_rules.with_parts(table(spark, sf_dir, "pages").select("page_id", "url"))
    mined = url_rules.mined_rules(labelled_urls(spark, sf_dir, pages))
    return url_rules.judged(pages, RULES, mined).select("page_id", "host", "path", "rule", "verdict")


QUERIES = {"op4_url_filter": op4_url_filter}
ORACLE: dict[str, str] = {}

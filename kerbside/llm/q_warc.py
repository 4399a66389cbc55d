"""op7: every page written to WARC archives and read back through the index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import warc
from kerbside.llm.tables import fresh_folder, stored, table


def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = fresh_folder(spark, "warc")
    index = stored(warc.write_archives(warc.with_record_types(pages), folder), "warc-index")
    back = warc.read_records(index, folder, with_payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op7_warc_round_trip": op7_warc_round_trip}
ORACLE = {
    "op7_warc_round_trip": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id < page_id THEN first_id END AS refers_to
FROM f
"""
}

"""op12: a quarter of the documents drawn towards the benchmark's word distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import resample
from kerbside.llm.sql_text import CRC32, crc32_of
from kerbside.llm.tables import table


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample.resampled(docs, table(spark, sf_dir, "benchmark").select("text"))


QUERIES = {"op12_importance_resampling": op12_importance_resampling}
ORACLE = {
    "op12_importance_resampling": CRC32
    + r"""
, words AS (
  SELECT true AS given, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT false, NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), features AS MATERIALIZED (
  SELECT given, doc_id, feature, count(*) AS n
  FROM (SELECT given, doc_id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS feature FROM words)
  GROUP BY ALL
), hashed AS MATERIALIZED (
  SELECT feature, """
    + crc32_of("feature")
    + r""" % 10000 AS bucket FROM (SELECT DISTINCT feature FROM features), crc_table
), counts AS (
  SELECT bucket, sum(n) FILTER (given) AS s, sum(n) FILTER (NOT given) AS t FROM features JOIN hashed USING (feature) GROUP BY bucket
), totals AS (
  SELECT coalesce(sum(s), 0)::DOUBLE + 10000 AS s_all, coalesce(sum(t), 0)::DOUBLE + 10000 AS t_all FROM counts
), gains AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0)::DOUBLE + 1) * s_all) / ((coalesce(s, 0)::DOUBLE + 1) * t_all)))::BIGINT AS gain FROM counts, totals
), weights AS (
  SELECT doc_id, sum(n) AS n, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
  FROM features JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE given GROUP BY doc_id
), scores AS (
  SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN weights USING (doc_id)
), places AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS total FROM scores WHERE n_features >= 39
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * total // 100 THEN place END AS rank
FROM scores LEFT JOIN places USING (doc_id)
"""
}

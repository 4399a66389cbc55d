"""Training-corpus pipeline: quality, near duplicates, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes each stage's result
to the shared folder and reads it again as the next stage's input. Columns a
stage does not know are passed on; null ids and texts, empty texts, repeated
rows and empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import decontam, ngram_join, packing, pii, quality
from kerbside.llm.q_packing import vocabulary_path
from kerbside.llm.tables import stored, table

SHINGLE_WORDS, SIMILAR = 5, (80, 100)

# The stages fit a model, follow links and solve a linear program, which SQL does not express.
ORACLE_SQL = None


KNOWN = ("doc_id", "text", "lang", "source", "n_chars")
BATCH_ROWS = "1000"  # whole texts a batch of rows may hold in a Python worker and in its executor


def _sheltered(stage):
    """Gives further columns neutral names while a stage works, so that none clashes with the operators' own; bounds the batches."""

    @wraps(stage)
    def inner(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        others = {c: f"__other_{i}" for i, c in enumerate(c for c in docs.columns if c not in KNOWN)}
        done = stage(spark, docs.withColumnsRenamed(others), sf_dir)
        return done.withColumnsRenamed({v: k for k, v in others.items()})

    return inner


def _with_text(docs: DataFrame, text) -> DataFrame:
    """The same columns with another text; n_chars is that text's length where it was known."""
    changed = docs.withColumn("__new", text)
    n_chars = F.when(F.col("__new").eqNullSafe(F.col("text")), F.col("n_chars")).otherwise(F.length("__new").cast(docs.schema["n_chars"].dataType))
    return changed.withColumn("n_chars", n_chars).withColumn("text", F.col("__new")).drop("__new")


@_sheltered
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    machine = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, machine).filter(F.col("score") >= quality.THRESHOLD).select(*docs.columns)


@_sheltered
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of alike documents the one with the least id stays.

    Rows without an id or without words are in no group. If the kept id stands
    in several rows, one of them stays.
    """
    groups = ngram_join.similar_groups(docs, SHINGLE_WORDS, *SIMILAR)
    gone = groups.filter(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = groups.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    single = kept.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    others = [c for c in docs.columns if c != "doc_id"]
    # The rows share a group, so any may stay; this one does not depend on their order.
    best = F.max_by(F.struct(*others), F.struct(*(c for c in others if c in KNOWN)))
    first = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(best.alias("r"))
    return single.unionByName(first.select("doc_id", *(F.col("r")[c].alias(c) for c in others)).select(*docs.columns))


@_sheltered
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts."""
    found = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    cut = _with_text(found, decontam.without_spans(F.col("text"), F.col("hits")))
    return cut.select(*docs.columns)


@_sheltered
def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind."""
    found = pii.find_personal_data(docs, keep=docs.columns)
    return _with_text(found, F.col("masked")).select(*docs.columns)


@_sheltered
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: where it starts in its document and where it is placed."""
    done = packing.pack_documents(docs, vocabulary_path())
    return done.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality", quality_stage), ("near_duplicates", near_duplicate_stage), ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage), ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

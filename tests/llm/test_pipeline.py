"""The pipeline's stages, one after the other, against brute force."""

from __future__ import annotations

import re

import corpus_pipeline as pipeline
from kerbside.llm import pii, quality
from kerbside.llm.tables import stored, table
from test_decontam import brute as hit_words
from test_ngram_join import brute as groups_of

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, items string, score string, cls int"


def odd_rows(spark):
    prose = "The thing that was there and of the other one which they had seen before in that place. " * 8
    rows = [
        (1, prose, "en", "a", len(prose)), (2, prose, "en", "a", len(prose)), (3, prose + "More.", None, None, None),
        (None, prose, "en", "a", 1), (4, "", "en", None, 0), (5, None, None, None, None), (6, "mail me@example.com " + prose, "en", "b", 9),
        (7, "word " * 9000, "en", "c", 45000), (1, prose, "en", "a", len(prose)),
    ]
    return spark.createDataFrame([(*r, "i", "s", 3) for r in rows], EXTRA)


def test_stages_keep_columns_and_run_on_odd_rows(spark):
    docs = odd_rows(spark)
    for name, stage in pipeline.STAGES[1:-1]:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.columns == [*COLUMNS, "items", "score", "cls"], name
    kept = docs.collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [1, 4, 5, 7]
    assert any(r["doc_id"] is None for r in kept)
    assert {r["items"] for r in kept} == {"i"}
    packed = pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == {None, 1, 4, 5, 7}
    assert max(r["offset"] + r["length"] for r in packed) <= 4096


def test_stages_run_on_an_empty_table(spark):
    docs = spark.createDataFrame([], EXTRA)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_stages_equal_brute_force(spark):
    docs = table(spark, SF, "documents")
    good = stored(pipeline.quality_stage(spark, docs, SF), "good")
    before = [tuple(r[c] for c in COLUMNS) for r in docs.collect()]
    after = {r["doc_id"]: r for r in good.collect()}
    marks = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    known = [d for d, *_ in before if d in marks]
    assert sum((d in after) == bool(marks[d]) for d in known) >= 0.9 * len(known)
    assert all(tuple(after[r[0]]) == r for r in before if r[0] in after)

    single = stored(pipeline.near_duplicate_stage(spark, good, SF), "single")
    groups = groups_of([(r["doc_id"], r["text"]) for r in after.values()], 5, 80, 100)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(d for d, _, c in groups if c == d)

    clean = stored(pipeline.decontamination_stage(spark, single, SF), "clean")
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    texts = {r["doc_id"]: r["text"] for r in single.collect()}
    hits = {d: (words, hit) for d, words, hit, *_ in hit_words(list(texts.items()), items)}
    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    for r in clean.collect():
        words, hit = hits[r["doc_id"]]
        assert len(word.findall(r["text"])) == words - hit
        assert r["text"] == texts[r["doc_id"]] if not hit else len(r["text"]) == r["n_chars"]
    assert any(hit for _, hit in hits.values())

    masked = pipeline.personal_data_stage(spark, clean, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert all(r["text"] == pii.masked(texts[r["doc_id"]], pii.spans(texts[r["doc_id"]])) for r in masked)
    assert not any(pii.spans(r["text"]) for r in masked)


def test_run_is_the_last_stage(spark):
    done = pipeline.run(spark, SF)
    assert done.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert done.select("doc_id").distinct().count() > 50
    assert quality.THRESHOLD == 0.7

"""Benchmark decontamination against brute force."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

from kerbside.llm import decontam
from kerbside.llm.fm_index import FMIndex
from kerbside.llm.q_decontam import op10_decontaminate
from kerbside.llm.tables import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(docs, items, window=10):
    tests = [(str(i), WORD.findall(lower(t))) for i, t in items if i is not None]
    windows = {}
    for item, words in tests:
        for at in range(max(1, len(words) - window + 1)) if words else ():
            windows.setdefault(tuple(words[at : at + window]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words = WORD.findall(lower(text))
        hit, found = set(), set()
        for n in sizes:
            for at in range(len(words) - n + 1):
                owners = windows.get(tuple(words[at : at + n]))
                if owners:
                    hit |= set(range(at, at + n))
                    found |= owners
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def query_rows(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in df.collect()), key=repr)


def summed(found):
    rows = []
    for r in found.collect():
        hit = sum(h["last"] - h["first"] + 1 for h in r["hits"])
        rows.append((r["doc_id"], r["n_words"], hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), hit > 0))
    return sorted(rows, key=repr)


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(3)
    for _ in range(60):
        largest = int(rng.integers(1, 6))
        text = np.r_[rng.integers(0, largest + 1, rng.integers(1, 150)), 0]
        index = FMIndex(text, largest)
        for n in (1, 2, 4):
            patterns = rng.integers(1, largest + 1, (10, n))
            for pattern, low, high in zip(patterns, *index.search(patterns), strict=True):
                want = [i for i in range(len(text) - n + 1) if (text[i : i + n] == pattern).all()]
                assert sorted(index.locate(np.arange(low, high)).tolist()) == want


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    want = brute(docs, items)
    assert query_rows(op10_decontaminate(spark, SF)) == want
    assert any(r[5] for r in want)


@pytest.mark.parametrize("block_chars", [1 << 25, 60])
def test_odd_rows_and_several_blocks(spark, block_chars):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    items = [(10, passage), (2, "Short Item"), (2, "alpha beta"), (None, "never used here"), (3, None), (4, "...")]
    docs = [
        (1, f"x {passage.upper()} y short, item", "a"), (1, f"x {passage.upper()} y short, item", "a"), (2, None, None), (None, "short item short item", "b"),
        (3, "", None), (4, "élan " * 3000 + passage + " tail", "c"), (5, "alpha beta" * 2, "n_words"),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string, items string")
    b = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, n_words int")
    found = decontam.find_contamination(d, b, keep=["doc_id"], block_chars=block_chars)
    assert summed(found) == brute([r[:2] for r in docs], items)


def test_spans_cut_the_passage(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Keep. One two, three four five six seven eight nine ten ELEVEN! Stay", "x"), (2, "clean", "y")], "doc_id long, text string, lang string")
    found = decontam.find_contamination(docs, items)
    cut = {r["doc_id"]: r["t"] for r in found.select("doc_id", decontam.without_spans(found["text"], found["hits"]).alias("t")).collect()}
    assert cut == {1: "Keep.  ! Stay", 2: "clean"}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find_contamination(docs, none).count() == 0
    row = decontam.find_contamination(some, none).first()
    assert (row["n_words"], row["hits"], row["items"]) == (2, [], [])

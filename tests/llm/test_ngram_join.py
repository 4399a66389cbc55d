"""N-gram Jaccard join against brute force over all pairs."""

from __future__ import annotations

import random
import re

import pytest

from kerbside.llm import ngram_join
from kerbside.llm.q_ngram import op5_ngram_jaccard
from kerbside.llm.tables import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, words, num, den):
    sets = []
    for _, text in docs:
        found = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set())
    root = {d: d for d, _ in docs if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, _) in enumerate(docs):
        for j in range(i):
            b = docs[j][0]
            if a is None or b is None or not sets[i] or not sets[j]:
                continue
            common = len(sets[i] & sets[j])
            if den * common >= num * (len(sets[i]) + len(sets[j]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted(((d, len(s), None if d is None else find(d)) for (d, _), s in zip(docs, sets, strict=True)), key=repr)


def rows(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_shingles", "component_id")) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    want = brute(docs, 4, 85, 100)
    assert rows(op5_ngram_jaccard(spark, SF)) == want
    assert any(r[0] != r[2] for r in want)


@pytest.mark.parametrize(("words", "num", "den"), [(4, 85, 100), (5, 80, 100), (2, 50, 100)])
def test_mutated_copies_and_odd_rows(spark, words, num, den):
    draw = random.Random(num)
    vocabulary = [f"w{i}" for i in range(400)]
    common = " ".join(draw.choices(vocabulary, k=40))
    docs, number = [], 0
    for _ in range(12):
        base = draw.choices(vocabulary, k=draw.randint(3, 120))
        for _ in range(draw.randint(1, 9)):
            text = list(base)
            for _ in range(draw.randint(0, 6)):
                text[draw.randrange(len(text))] = draw.choice(vocabulary)
            docs.append((number, " ".join(text) + (" " + common if draw.random() < 0.5 else "")))
            number += 1
    docs += [(900, None), (901, ""), (902, " \t"), (903, "One"), (904, "one"), (None, docs[0][1]), (905, common), (906, common.upper()), (905, common), (907, common + " tail")]
    d = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id long, text string, cls string, n string")
    assert rows(ngram_join.similar_groups(d, words, num, den)) == brute(docs, words, num, den)


def test_empty_table(spark):
    assert ngram_join.similar_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bounds_never_miss():
    draw = random.Random(5)
    hashes = ngram_join._Hashes()
    for _ in range(200):
        words = [f"v{draw.randrange(60)}" for _ in range(draw.randint(5, 90))]
        other = [w if draw.random() < 0.9 else "z" for w in words][: draw.randint(4, 90)]
        x, y = (ngram_join.shingle_set(" ".join(w), 3, hashes) for w in (words, other))
        common = len(set(x.tolist()) & set(y.tolist()))
        assert common <= ngram_join.overlap_bound(ngram_join.signature(x), len(x), ngram_join.signature(y), len(y))
    edges = ngram_join.size_bands(85, 100)
    band = lambda n: sum(e <= n for e in edges)
    for n in range(1, 4000, 7):
        assert band(n * 100 // 85) - band(n) in (0, 1)


def test_components_follow_long_chains(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    found = {r["cls"]: r["root"] for r in ngram_join.components(chain).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_every_copy_meets_the_least_changed_one(spark):
    """Copies that lost the element most others share, and do not ask for it, are still paired with the text they come from."""
    whole = 1
    postings = [(token, whole, 100, pos) for pos, token in enumerate(range(10, 16))]
    for copy in range(2, 60):
        kept = [t for t in range(10, 16) if t != 10 + copy % 6]
        postings += [(token, copy, 100, pos) for pos, token in enumerate(kept)]
    pairs = ngram_join._pivot_pairs(spark.createDataFrame(postings, "token long, cls long, n int, pos int"), 80, 100).collect()
    assert {r["b"] for r in pairs if r["a"] == whole} == set(range(2, 60))
    assert len(pairs) <= 59 * 2 * ngram_join.PIVOTS
    assert len({(r["a"], r["b"]) for r in pairs}) == len(pairs) and all(r["a"] < r["b"] for r in pairs)

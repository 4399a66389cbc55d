"""Sharding, importance resampling and prefix tries against plain Python on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import kd_shards, prefix_trie, resample
from kerbside.llm.q_shards import DIMENSIONS, SHARDS, op11_kd_sharding
from kerbside.llm.tables import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Sharding


def plain_tree(rows, shards):
    """The same tree by sorting: rows are (places, tie, size); gives a shard per row."""
    wide = [max((r[0][d] for r in rows), default=0) - min((r[0][d] for r in rows), default=0) for d in range(len(rows[0][0]))] if rows else []
    found = [None] * len(rows)

    def cut(part, first, k):
        if k == 1 or not part:
            for i in part:
                found[i] = first
            return
        widths = [(max(rows[i][0][d] for i in part) - min(rows[i][0][d] for i in part)) / max(1, wide[d]) for d in range(len(wide))]
        d = widths.index(max(widths))
        total, sums = sum(rows[i][2] for i in part), Counter()
        for i in part:
            sums[rows[i][0][d], rows[i][1]] += rows[i][2]
        ahead, best = 0, (abs(total * (k // 2)), 0, None)
        for n, key in enumerate(sorted(sums), 1):
            ahead += sums[key]
            best = min(best, (abs(ahead * k - total * (k // 2)), n, key), key=lambda b: b[:2])
        last = best[2]
        cut([i for i in part if last is not None and (rows[i][0][d], rows[i][1]) <= last], first, k // 2)
        cut([i for i in part if last is None or (rows[i][0][d], rows[i][1]) > last], first + k // 2, k - k // 2)

    cut(list(range(len(rows))), 0, shards)
    return found


def check_shards(spark, monkeypatch, docs, shards, dims):
    seen = {}
    inner = kd_shards._grouped

    def spy(*given):
        seen["base"] = inner(*given).cache()
        return seen["base"]

    monkeypatch.setattr(kd_shards, "_grouped", spy)
    done = kd_shards.kd_shards(docs, shards, dims).collect()
    base = seen["base"].collect()
    want = Counter(
        (r["doc_id"], r["text_crc32"], s)
        for r, s in zip(base, plain_tree([(tuple(r["places"]), r["tie"], r["size"]) for r in base], shards), strict=True)
    )
    assert Counter((r["doc_id"], r["text_crc32"], r["shard"]) for r in done) == want
    slots = defaultdict(list)
    for r in done:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return done


def test_query_is_the_tree_by_sorting(spark, monkeypatch):
    docs = table(spark, SF, "documents")
    done = check_shards(spark, monkeypatch, docs, SHARDS, DIMENSIONS)
    given = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    rows = op11_kd_sharding(spark, SF).collect()
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in rows) == sorted((r["doc_id"], r["shard"], r["slot"]) for r in done)
    for r in rows:
        data = (given[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 8, zlib.crc32(data), "bytes", None)
    assert {r["shard"] for r in rows} == set(range(SHARDS))


@pytest.mark.parametrize("shards", [1, 2, 5, 24])
def test_shards_of_odd_rows(spark, monkeypatch, shards):
    draw = random.Random(shards)
    rows = [(None, None, None, None, None), (1, "", "a", 1.0, "x"), (1, "", "a", 1.0, "x"), (2, "é" * 900, None, float("nan"), "y")]
    rows += [(i, "w" * draw.randint(0, 60), draw.choice("abc"), draw.choice([None, 1.5, 7.0, float("inf")]), "z") for i in range(3, 200)]
    rows += [(i, "copy of one text", draw.choice("abcdef"), float(i), "z") for i in range(200, 420)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, at double, size string")
    check_shards(spark, monkeypatch, docs, shards, ["source", "at"])


def test_groups_move_as_one_and_bytes_are_near_equal(spark):
    draw = random.Random(4)
    rows = [(i, f"text {i % 2000} " + "v" * (i % 2000 % 97), draw.choice("abcdefgh"), draw.random()) for i in range(6000)]
    done = kd_shards.kd_shards(spark.createDataFrame(rows, "doc_id long, text string, source string, at double"), 8, ["source", "at"]).collect()
    of, held = defaultdict(set), Counter()
    for r in done:
        of[rows[r["doc_id"]][1]].add(r["shard"])
        held[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in of.values())
    assert max(held.values()) < 1.02 * sum(held.values()) / 8 and len(held) == 8


def test_no_rows_in_shards(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string, at timestamp")
    assert kd_shards.kd_shards(empty, 24, ["source", "at"]).count() == 0


def test_sharding_needs_no_python_workers(spark):
    plan = op11_kd_sharding(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|ExistingRDD", plan)


# Resampling


def plain_features(text):
    words = WORD.findall((text or "").translate(UPPER))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)], len(words)


def plain_draw(docs, target, share, least, buckets):
    source, wanted = Counter(), Counter()
    for _, text in docs:
        source.update(zlib.crc32(f.encode()) % buckets for f in plain_features(text)[0])
    for text in target:
        wanted.update(zlib.crc32(f.encode()) % buckets for f in plain_features(text)[0])
    s_all, t_all = sum(source.values()) + buckets, sum(wanted.values()) + buckets
    out = []
    for doc_id, text in docs:
        found, words = plain_features(text)
        hit = [zlib.crc32(f.encode()) % buckets for f in found]
        gains = [math.floor(1000 * math.log((wanted[b] + 1) * s_all / ((source[b] + 1) * t_all))) for b in hit]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): i for i, r in enumerate(fit[: share[0] * len(fit) // share[1]], 1)}
    return sorted((tuple(r[:4]) + (ranks.get(id(r)),) for r in out), key=repr)


@pytest.mark.parametrize(("share", "least", "buckets"), [((25, 100), 20, 10_000), ((1, 2), 0, 7), ((1, 1), 3, 500), ((0, 5), 0, 10)])
def test_draw_equals_plain_reading(spark, share, least, buckets):
    draw = random.Random(least)
    vocabulary = ["Word", "été", "x9", "naïve", "日本", "a", "b", "q" * 60, "q" * 47 + "é", "I", "İ"]
    docs = [(i, draw.choice([" ", "-", "\n\x00", "/"]).join(draw.choices(vocabulary, k=draw.randint(0, 60)))) for i in range(300)]
    docs += [(None, None), (900, ""), (901, " .,"), (902, "one"), (902, "one"), (903, "Q" * 5000 + " é" * 3000), (None, "a b " * 30), (904, None)]
    docs += [(905, "same words " * 15)] * 40
    target = ["a b a b", None, "", "été X9 " * 8]
    d = spark.createDataFrame([(i, t, 1, "n") for i, t in docs], "doc_id long, text string, score int, ordinal string").repartition(5)
    t = spark.createDataFrame([(x,) for x in target], "text string")
    got = [tuple(r) for r in resample.resampled(d, t, share, least, buckets).select("doc_id", "n_features", "weight", "score", "rank").collect()]
    want = plain_draw(docs, target, share, least, buckets)
    # Among equal rows any may hold a rank, so rows are compared as a multiset.
    assert sorted(got, key=repr) == want


def test_blocks_are_cut_between_texts(spark, monkeypatch):
    docs = [(i, " ".join(f"w{i * j % 31}" for j in range(40))) for i in range(60)]
    monkeypatch.setattr(resample, "BLOCK_BYTES", 300)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = resample.resampled(d, d.limit(5)).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert {r["n_features"] for r in got} == {79} and sum(r["rank"] is not None for r in got) == 15


@pytest.mark.parametrize("margin", [0.0, 0.002])
def test_brackets_that_miss_are_widened(spark, monkeypatch, margin):
    monkeypatch.setattr(resample, "FIRST_MARGIN", margin or 1e-6)
    monkeypatch.setattr(resample, "SKETCH_ACCURACY", 5)
    scores = [(i * 7919) % 1000 for i in range(5000)]
    rows = spark.createDataFrame([(s,) for s in scores], "score long")
    for quota in (1, 2, 1249, 1250, 4999, 5000):
        assert resample.cutoff_score(rows, quota, 5000) == sorted(scores, reverse=True)[quota - 1]


def test_no_rows_to_draw(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert resample.resampled(empty, empty).count() == 0


def test_words_are_hashed_like_zlib():
    texts = ["", "one", "Two words", "é" * 30 + " z", "x" * 48 + " " + "y" * 49, "a/b", "tail"]
    data = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, data)])
    found, owner = resample.block_features(np.frombuffer(b"".join(data), np.uint8), bounds, 2**32 - 1)
    want = Counter((i, zlib.crc32(f.encode()) % (2**32 - 1)) for i, t in enumerate(texts) for f in plain_features(t)[0])
    assert Counter(zip(owner.tolist(), found.tolist(), strict=True)) == want


# Prefix trie


def plain_trie(turns):
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:]
    nodes = defaultdict(list)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            nodes[tuple(v[:d])].append(c)
    children = Counter(n[:-1] for n in nodes if n)
    leaves, saved = Counter(), Counter()
    for n, convs in nodes.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in children
            saved[n[:d]] += (len(convs) - 1) * len(n[-1][1]) if n else 0
    return sorted(
        (
            min(convs), len(n), min(nodes[n[:-1]]) if n else None, len(convs), children[n], leaves[n], saved[n],
            hashlib.sha256(",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(n)).encode()).hexdigest(),
        )
        for n, convs in nodes.items()
    )


def same_trie(spark, turns):
    given = spark.createDataFrame([(*t, 5, "x") for t in turns], "conv_id long, turn long, role string, text string, depth int, up string").repartition(4)
    got = sorted(tuple(r) for r in prefix_trie.prefix_trie(given).collect())
    assert got == plain_trie(turns)


def test_trie_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 8)
    monkeypatch.setattr(prefix_trie, "IDS_A_ROW", 3)
    draw = random.Random(11)
    turns = [(None, 0, "user", "lost"), (7, None, None, None), (7, 3, "user", "late"), (7, None, "a", "x"), (8, 1, "", ""), (8, 1, "", ""), (-5, 0, "user", "minus"), (-105, 0, "user", "minus")]
    turns += [(c, t, draw.choice(["user", "assistant"]), draw.choice(["", "hé", "日本語"])) for c in range(100, 190) for t in range(draw.randint(1, 7))]
    turns += [(c, t, "user", f"turn {t}") for c in (300, 301, 417) for t in range(150)]
    turns += [(c, t, "user", "same") for c in range(500, 540) for t in range(3)]
    same_trie(spark, turns)


def test_trie_under_one_crowded_parent(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "LEAST_HOT", 5)
    monkeypatch.setattr(prefix_trie, "HOT_SHARE", 50)
    turns = [(c, t, "user", "shared" if t == 0 or c % 3 == 0 and t < 4 else f"{c} {t}") for c in range(1000, 1200) for t in range(6 + c % 5)]
    same_trie(spark, turns)


def test_trie_without_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(empty).count() == 0
    assert prefix_trie.prefix_trie(empty.union(spark.sql("SELECT NULL, 1, 'user', 'x'"))).count() == 0


def test_chains_halve_in_every_round(spark, monkeypatch):
    rounds = []
    inner = prefix_trie._marked
    monkeypatch.setattr(prefix_trie, "_marked", lambda tree: (rounds.append(tree.count()), inner(tree))[1])
    turns = spark.range(400).select(F.lit(1000).alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"), F.col("id").cast("string").alias("text"))
    assert prefix_trie.prefix_trie(turns).count() == 401
    assert len(rounds) <= 10

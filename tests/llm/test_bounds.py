"""Bounded work in one row and in the driver, clashing names, and the packing program against known optima."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kerbside.llm import packing, pii, quality, warc
from kerbside.llm.q_packing import vocabulary_path
from kerbside.llm.word_merges import WordMerges


def triplets(n: int, seed: int, least: int) -> np.ndarray:
    rng, out = np.random.default_rng(seed), []
    while len(out) < 3 * n:
        a, b = rng.integers(least, packing.CAPACITY - 2 * least, 2)
        if packing.CAPACITY - a - b >= least:
            out += [a, b, packing.CAPACITY - a - b]
    return np.array(out)


def held(plan):
    out: dict[int, int] = {}
    for contents, number in plan:
        assert sum(size * n for size, n in contents.items()) <= packing.CAPACITY
        for size, n in contents.items():
            out[size] = out.get(size, 0) + n * number
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_triplets_that_fill_sequences_are_packed_near_the_optimum(seed):
    sizes, demand = np.unique(triplets(2000, seed, 200), return_counts=True)
    plan, bound = packing.bounded_plan(sizes.astype(np.int64), demand.astype(np.int64))
    assert held(plan) == dict(zip(sizes.tolist(), demand.tolist(), strict=True))
    assert bound == pytest.approx(2000) and sum(n for _, n in plan) <= 2010


def test_program_covers_every_length_and_bounds_from_below():
    for sizes, demand, best in [([5, 1100, 3000], [3, 40, 50], 64), ([1496, 2600], [90, 70], 80), ([1500, 2600], [90, 70], 115), ([4095], [7], 7), ([1], [4096 * 3], 3)]:
        sizes, demand = np.array(sizes, np.int64), np.array(demand, np.int64)
        use, bound = packing.fractional_cover(sizes, demand.astype(float), packing.CAPACITY)
        covered = np.zeros(len(sizes))
        for items, times in use.items():
            assert sizes[list(items)].sum() <= packing.CAPACITY
            np.add.at(covered, list(items), times)
        assert (covered >= demand - 1e-6).all()
        plan, whole = packing.bounded_plan(sizes, demand)
        assert whole <= best + 1e-9 and sum(n for _, n in plan) == best


def test_merged_words_equal_the_tokenizer():
    rng = random.Random(6)
    words = {"".join(rng.choices("etaoinsé", k=rng.randint(1, 24))) for _ in range(4000)} | {c * n for c in "aeé" for n in range(1, 40)} | {"ab" * n for n in range(1, 20)}
    words = sorted(words)
    whole = Tokenizer.from_file(vocabulary_path())
    for word, ids in zip(words, WordMerges(vocabulary_path()).encode(words), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(word, add_special_tokens=False).ids
    assert WordMerges(vocabulary_path()).encode([]) == []


def test_stretches_keep_the_ids_of_whole_texts():
    rng = random.Random(7)
    letters = "abcdeéïßŉſẞAZÀÖØĲĳİı .,;:!?'\"()-|<>#$%&*[]`{}~@^_=+/\\\n\t\r    0123 \u0301"
    texts = ["", "\n", " x, y", "a,b c,", "ab\u0301, c", "日本, b. c", "<|endoftext|>, a.", "<|endoftext|> b", "x<|startoftext|>", "don't' we'll\" it's) 've's", None] + ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(8000)]
    whole = Tokenizer.from_file(vocabulary_path())
    for text, ids in zip(texts, packing.ChunkTokens(vocabulary_path()).ids(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids, text


def test_a_full_cache_is_emptied_and_learnt_again(monkeypatch):
    monkeypatch.setattr(packing, "MOST_CACHED", 40)
    monkeypatch.setattr(packing, "GROUP_TEXTS", 3)
    texts = [" ".join(f"word{i * j % 97}x" for j in range(20)) for i in range(30)]
    fresh = packing.ChunkTokens(vocabulary_path())
    whole = Tokenizer.from_file(vocabulary_path())
    for text, ids in zip(texts, fresh.ids(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_many_spans_in_one_text_take_time_in_proportion():
    one = "tel 0171 5553 222 and +49 171 555 3222, "
    assert {k for _, k, _, _ in pii.spans(one)} == {3, 5}
    took = []
    for n in (4000, 16000):
        start = time.process_time()
        found = pii.spans(one * n)
        took.append(time.process_time() - start)
        assert len(found) == 2 * n
    assert took[1] < 12 * took[0]


def test_merged_stretches_decide_as_all_pairs_do():
    rng = random.Random(1)
    for _ in range(300):
        spans = [(s := rng.randrange(60), 0, s + rng.randint(1, 9)) for _ in range(rng.randrange(8))]
        stretches = pii._merged(spans)
        for start in range(70):
            for end in (start + 1, start + 4):
                assert any(s < end and start < e for s, _, e in spans) == any(s < end and start < e for s, e in stretches)


def test_given_columns_may_have_the_operators_own_names(spark):
    docs = spark.createDataFrame([(1, "mail a@b.example now", 20, "x", "y")], "doc_id long, text string, n_chars int, __text string, __stated string")
    out = pii.find_personal_data(docs).collect()[0]
    assert (out["__text"], out["__stated"], out["masked"]) == ("x", "y", "mail [EMAIL] now")
    machine = quality.Machine(0.0, np.zeros(quality.BUCKETS + len(quality.STATISTICS), np.float32), np.zeros((quality.BUCKETS + len(quality.STATISTICS), 2), np.float32))
    assert quality.scored(docs, machine).collect()[0]["__text"] == "x"


def test_a_repeated_id_is_one_training_row(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows, good, seed=7: seen.append(len(rows)) or quality.Machine(0.0, np.zeros(1), np.zeros((1, 1))))
    docs = spark.range(300).select(F.lit(4).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), F.lit(6).alias("n_chars"))
    labels = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, quality int")
    quality.fit_quality(docs, labels)
    assert seen[0] <= 1


@pytest.mark.parametrize("url", ["http://a/%20b", "http://a/%2520b?x=1%", "http://a/é b", "http://a/x\ny%0Az", "", None])
def test_urls_stand_in_the_archive_as_given(url):
    row = {"page_id": 1, "url": url, "payload": b"x", "payload_digest": "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881", "record_type": "response", "refers_to": None}
    data = warc._record(row)
    assert warc.parse_record(data)["url"] == url
    if url and "\n" not in url:
        assert f"WARC-Target-URI: {url}\r\n".encode() in data

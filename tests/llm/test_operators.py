"""The training-text operators against brute force on small tables, with odd rows of every kind."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest

from kerbside.llm import chat, html_text, packing, pii, q_chat, q_html, q_packing, q_pii, q_quality, q_url, quality, topk, url_rules, warc
from kerbside.llm.tables import fresh_folder, stored, table

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# --- chat -----------------------------------------------------------------------------


def hostile(rnd: random.Random) -> str:
    parts = ["<|im_start|>", "<|im_end|>", "<|nl|>", "<\\|im_end|>", "<\\\\|", "<", "|", "\\", "\n", "assistant", "$1", "é🙂", " ok"]
    return "".join(rnd.choice(parts) for _ in range(rnd.randrange(7)))


def test_chat_turns_come_back(spark):
    rnd = random.Random(5)
    rows = [(c, t, rnd.choice(["user", "assistant", hostile(rnd), None]), rnd.choice([None, "plain", hostile(rnd), hostile(rnd)])) for c in [None, *range(60)] for t in range(rnd.randrange(1, 5))]
    turns = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn int, role string, text string, formatted int")
    done = chat.formatted_conversations(turns).withColumn("turns", chat.parsed(q_chat.F.col("formatted"))).collect()
    assert len(done) == 61
    for r in done:
        want = [(role or "", text or "") for c, _, role, text in rows if c == r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == want
        spoken = [r["formatted"][s["start"] : s["start"] + s["length"]] for s in r["loss_spans"]]
        assert [re.sub(r"<\\(\\*)\|", r"<\1|", s) for s in spoken] == [t for role, t in want if role == "assistant"]
    assert chat.formatted_conversations(turns.limit(0)).count() == 0


# --- HTML -----------------------------------------------------------------------------


PAGES = [
    (None, ""), ("", ""), ("<p>", ""), ("<p>a&amp;b \n c&nbsp;d</p>", "a&b c d"),
    (
        "<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a href=x>Home</a></nav>"
        "<article><h1>Head</h1><p>First   <b>bold</b> words.</p><div class='advert'>Buy</div><p>Second &lt;one&gt;.</p></article>"
        "<section class=comments><p>Nice article indeed.</p></section><footer>(c)</footer><script>if (a < b) { x() }</script></body></html>",
        "Head\n\nFirst bold words.\n\nSecond <one>.",
    ),
    ("<article><p>One.</p><!-- <p>no</p> --><p>Two", "One.\n\nTwo"),
]


def test_main_text_of_pages(spark):
    pages = spark.createDataFrame([(i, h, "x") for i, (h, _) in enumerate(PAGES)] * 2, "page_id long, html string, weight string")
    got = html_text.extract_main_text(pages).collect()
    assert len(got) == 2 * len(PAGES)
    assert {r["page_id"]: r["main_text"] for r in got} == {i: t for i, (_, t) in enumerate(PAGES)}
    assert html_text.extract_main_text(pages.limit(0)).count() == 0
    long = "<article>" + "<p>word word word.</p>" * 30_000 + "</article>"
    assert html_text.main_text(long).count("\n\n") == 29_999


FULL = [
    # names that tell what an element has, or that wrap the page
    ("<div class='layout has-sidebar'><article><h1>T</h1><p>Some text.</p></article><div class=sidebar><p>no</p></div></div>", "T\n\nSome text."),
    ("<div class='layout has-sidebar'><div><p>Some text.</p><p>More.</p></div><div class=sidebar><p>no</p></div></div>", "Some text.\n\nMore."),
    ("<form action=x><nav><a href=1>Home</a></nav><article><h1>T</h1><p>Some text.</p></article><footer>c</footer></form>", "T\n\nSome text."),
    ("<form><div><h1>T</h1><p>Some text.</p><p>And more text.</p></div><footer>c</footer></form>", "T\n\nSome text.\n\nAnd more text."),
    # links inside the article
    ("<article><h1><a href=x>Head line</a></h1><p>One.</p></article>", "Head line\n\nOne."),
    ("<p><a href=x>Only a link here</a></p>", "Only a link here"),
    ("<article><p>One.</p><ul>" + "<li><a>a</a></li>" * 4 + "</ul><p>Two.</p></article>", "One.\n\na\n\na\n\na\n\na\n\nTwo."),
    # the article's own parts
    ("<article><div class=entry-header><h1>Head</h1></div><p>One.</p><p class=legal>Legal.</p></article>", "Head\n\nOne.\n\nLegal."),
    ("<div id=c><h1>T</h1><div class=ad>Buy</div><p>" + "word " * 50 + "</p></div>", "T\n\n" + " ".join(["word"] * 50)),
    # what stays outside
    ("<article><p>One <span class=advert><span>Buy</span> now cheap</span> two.</p></article>", "One two."),
    ("<article><p>One.</p><article class=comment><p>Reader.</p></article></article>", "One."),
    ("<div class=post><p>One text.</p></div><div class=comments><article class=comment><p>" + "Many words. " * 30 + "</p></article></div>", "One text."),
    ("<nav><a>x</a></nav><div class=ad>Buy this now.</div><article></article><footer>c</footer>", ""),
    ("<form><p>Search</p><p>Here</p><input></form><article><p>Text.</p></article>", "Text."),
]


@pytest.mark.parametrize("page, text", FULL)
def test_names_do_not_hide_the_article(page, text):
    assert html_text.main_text(page) == text


class PlainArticle(HTMLParser):
    """Text blocks of the article of a page, by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.blocks, self.inside, self.advert = [""], 0, 0

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.advert += tag == "div" and (self.advert > 0 or dict(attrs).get("class") == "ad")
        self.handle_data(" ") if tag == "br" else self.cut(tag)

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        self.advert -= tag == "div" and self.advert > 0
        self.cut(tag)

    def cut(self, tag):
        if tag in html_text.BLOCKS:
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside and not self.advert:
            self.blocks[-1] += data


def test_given_pages_equal_a_plain_reading(spark):
    for row in table(spark, SF, "pages").select("html").collect():
        plain = PlainArticle()
        plain.feed(row["html"] or "")
        plain.close()
        blocks = [" ".join(b.split()) for b in plain.blocks]
        assert html_text.main_text(row["html"]) == "\n\n".join(b for b in blocks if b)


def test_stray_tags_and_clashing_names(spark):
    start = time.time()
    many = 30_000
    assert html_text.main_text("<div><i>" + "<b>" * many + "x" + "</i></u></p>" * many) == "x"
    assert html_text.main_text("<div class=ad>" * many + "t" + "</div>" * many + "<p>x</p>") == "x"
    assert time.time() - start < 30
    rows = spark.createDataFrame([("<p>a</p>", 1, "b")], "html string, __html int, `a.b` string")
    assert html_text.extract_main_text(rows).collect()[0].asDict() == {"__html": 1, "a.b": "b", "main_text": "a"}


def test_every_page_is_returned(spark):
    assert q_html.op1_html_text(spark, SF).count() == table(spark, SF, "pages").count()


# --- personal data --------------------------------------------------------------------


def luhn(digits: str) -> bool:
    doubled = [int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    number = lambda m: re.sub("[^0-9]", "", m.group())
    found = []
    for order, (pattern, fits) in enumerate([
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(number(m)) <= 19 and luhn(number(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(number(m)) <= 15),
    ]):
        found += [(m.start(), order, m.end()) for m in re.finditer(pattern, text) if fits(m)]
    return [(s, e, pii.BASE[o]) for s, o, e in sorted(found)]


def personal(rnd: random.Random) -> str:
    parts = [
        "mail a.b@x-y.example.org", "é@", "a@b", "@", "@@c.d.", "1.2.3.4", "256.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "5500000000000004",
        "+1 (555) 010-9999", "+49.30.1234567", "+1", "🙂", " ", "call ", "٣", "GB82 WEST 1234 5698 7654 32", "ip ", "-", ".", "0" * 30,
    ]
    return "".join(rnd.choice(parts) for _ in range(rnd.randrange(9)))


def test_base_spans_equal_plain_patterns(spark):
    rnd = random.Random(9)
    texts = [personal(rnd) for _ in range(1500)] + [None, "", "a" * 50_000, "1." * 20_000, "a@" * 20_000, "+1 " * 20_000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r["doc_id"]: r for r in pii.find_personal_data(docs.drop("spans")).collect()}
    for i, text in enumerate(texts):
        assert [(s["start"], s["end"], s["kind"]) for s in got[i]["spans"] if s["kind"] in pii.BASE] == base_spans(text or ""), text
    assert pii.find_personal_data(docs.drop("spans").limit(0)).count() == 0


def test_personal_data_digest(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    for r in q_pii.op8_pii_spans(spark, SF).collect():
        want = base_spans(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(w[2] == k for w in want) for k in pii.BASE]


# --- quality --------------------------------------------------------------------------


def test_quality_on_rows_held_out(spark):
    marks = {r["doc_id"]: r["quality"] for r in table(spark, LARGER, "labels").collect()}
    rows = q_quality.op3_quality(spark, LARGER).collect()
    assert len(rows) == table(spark, LARGER, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    unseen = [(r["predicted"], marks[r["doc_id"]]) for r in rows if r["held_out"] and marks.get(r["doc_id"]) is not None]
    assert len(unseen) > 50 and sum(a == b for a, b in unseen) >= 0.85 * len(unseen)


def test_quality_of_odd_rows_and_linear_time_identity(spark):
    docs = spark.createDataFrame([(1, None, None, 0), (None, "", 0, 0), (1, "word " * 40_000, 5, 0)], "doc_id long, text string, n_chars long, score int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    machine = quality.fit_quality(docs, labels)
    assert [r["score"] for r in quality.scored(docs, machine).collect()] == pytest.approx([0.5] * 3)
    assert quality.scored(docs.limit(0), machine).count() == 0
    rng = np.random.default_rng(1)
    size = quality.BUCKETS + len(quality.STATISTICS)
    some = quality.Machine(0.1, rng.normal(0, 0.1, size), rng.normal(0, 0.3, (size, quality.RANK)))
    index, values = quality.features("the cat sat on the other mat", None, quality._Hashed())
    pairs = sum(float(some.factors[index[i]] @ some.factors[index[j]]) * values[i] * values[j] for i in range(len(index)) for j in range(i))
    z = 0.1 + float(values @ some.linear[index]) + pairs
    assert some.score(index, values) == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-5)


# --- top-k ----------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 7, 900])
def test_top_k_equals_brute_force(spark, n):
    rng = np.random.default_rng(n)
    x = np.round(rng.normal(0, 1, (n, 6)) * rng.choice([0.1, 1, 5], (n, 1)), 1)
    if n > 100:
        x[200:500] = x[200]  # a third of all rows is one vector
    rows = [(i, x[i].tolist(), "x") for i in range(n)] + [(10_000, None, "x"), (10_020, [1.0, None] * 3, "x"), (10_040, [float("nan")] * 6, "x"), (None, [1.0] * 6, "x")]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = topk.top_k(data, data.filter("vec_id % 20 = 0"), 5).collect()
    whole = np.floor(64 * x).astype(np.int64)
    want = set()
    for q in range(0, n, 20):
        scores = whole @ whole[q]
        best = sorted((i for i in range(n) if i != q), key=lambda i: (-scores[i], i))[:5]
        want |= {(q, k, i, int(scores[i])) for k, i in enumerate(best, 1)}
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == want and len(got) == len(want)


# --- URLs -----------------------------------------------------------------------------


def judged_plainly(url: str | None) -> tuple[str, str, str | None]:
    host, path = "", ""
    if url and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]
    fits = [r for r in q_url.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max((r.pattern for r in fits), key=len, default=None)


def test_urls_equal_plain_reading(spark):
    urls = [None, "", "no-scheme", "http://", "HTTP://A.Example.ORG/es/x?y", "http://example.org/en/12#f", "http://notexample.org/es/", "x://b.com/de/", "x://com/fr/a", "a://xcom/de/", "a://b?c://d/e", "a://É.org\n/x"]
    urls += [r["url"] for r in table(spark, SF, "pages").select("url").collect()]
    pages = url_rules.with_parts(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string"))
    got = {r["page_id"]: r for r in url_rules.judged(pages, q_url.RULES, [["bad", "token"]]).collect()}
    verdicts = {r.pattern: r.verdict for r in q_url.RULES}
    for i, url in enumerate(urls):
        host, path, rule = judged_plainly(url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), url
        assert got[i]["verdict"] == verdicts.get(rule, got[i]["verdict"])
    assert q_url.op4_url_filter(spark, SF).count() == table(spark, SF, "pages").count()


def test_mined_rules_have_support_and_confidence(spark):
    rows = [(["spam", f"t{i % 50}"], True) for i in range(300)] + [(["news", f"t{i % 50}"], i % 30 == 0) for i in range(600)] + [([], True), (None, True), (["x"], None)]
    rules = url_rules.mined_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean"))
    assert ["spam"] in rules and ["news"] not in rules
    empty = spark.createDataFrame([], "tokens array<string>, bad boolean")
    assert url_rules.mined_rules(empty) == []


# --- WARC -----------------------------------------------------------------------------


def test_warc_records_come_back(spark):
    long = "<p>é" * 60
    html = [None, "", "short", "short", long, long, long, "x" * 300_000, long + "."]
    rows = [(9 - i, f"http://h/{i} é\r\n" if i else None, h, "x") for i, h in enumerate(html)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, archive string").select("page_id", "url", "html")
    folder = fresh_folder(spark, "warc-test")
    index = stored(warc.write_archives(warc.with_record_types(pages), folder), "warc-test-index")
    back = {r["page_id"]: r for r in warc.read_records(index, folder).collect()}
    first: dict[bytes, int] = {}
    for page, url, text, _ in sorted(rows):
        data = (text or "").encode()
        older = first.setdefault(data, page) if len(data) >= 100 else page
        r = back.pop(page)
        assert (r["payload_bytes"], r["payload_digest"], r["url"]) == (len(data), hashlib.sha256(data).hexdigest(), url)
        assert (r["record_type"], r["refers_to"]) == (("revisit", older) if older != page else ("response", None))
        assert r["payload"] == (data if older == page else None)
    assert not back
    some = warc.read_records(index.filter("page_id = 2"), folder).collect()
    assert [r["page_id"] for r in some] == [2] and len(some[0]["payload"] or b"") == 300_000
    none = stored(warc.write_archives(warc.with_record_types(pages.limit(0)), fresh_folder(spark, "warc-none")), "warc-none-index")
    assert none.count() == 0


# --- packing --------------------------------------------------------------------------


def tokenised(texts: list[str | None]) -> list[list[int]]:
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(q_packing.vocabulary_path())
    return [whole.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_pieces_and_places(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    rows = q_packing.op2_best_fit_packing(spark, SF).collect()
    by_doc: dict[int, list] = {}
    by_sequence: dict[int, list] = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert by_doc.keys() == texts.keys()
    for (doc, pieces), ids in zip(sorted(by_doc.items()), tokenised([texts[d] for d in sorted(texts)]), strict=True):
        pieces.sort(key=lambda r: r["piece"])
        cut = [ids[k : k + 4096] for k in range(0, len(ids), 4096)]
        assert [(r["piece"], r["start"], r["length"]) for r in pieces] == [(k, 4096 * k, len(c)) for k, c in enumerate(cut)]
        assert [r["ids_crc32"] for r in pieces] == [zlib.crc32(np.array(c, "<u4").tobytes()) for c in cut], doc
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    least = -(-sum(r["length"] for r in rows) // 4096)
    assert len(by_sequence) <= 1.02 * least + 2


def test_odd_texts_are_tokenised_whole(spark):
    rnd = random.Random(2)
    letters = "aAbZéÉñßİıſKÅǅμ'’-_|.,!?\"()[]<>&#@0123 \t\n\r\u00a0\u2003\u200b\u200d中文дЖ🙂\u0301\x1f"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(60))) for _ in range(3000)] + [None, "", "|", "[UNK] don't DON'T", "x" * 20_000]
    tokens = packing.ChunkTokens(q_packing.vocabulary_path())
    assert [np.frombuffer(b, "<u4").tolist() + [1] for b in tokens.ids(texts)] == tokenised(texts)


def test_packing_plans_hold_the_histogram(spark):
    for sizes, demand in [([1], [5]), ([4096], [3]), ([2000, 2096], [7, 7]), ([1, 1365, 4095, 4096], [9, 30, 4, 2]), (list(range(1, 4097, 13)), [11] * 316)]:
        plan = packing.packing_plan(np.array(sizes), np.array(demand))
        held = dict.fromkeys(sizes, 0)
        for contents, number in plan:
            assert sum(s * c for s, c in contents.items()) <= 4096 and number > 0
            for s, c in contents.items():
                held[s] += c * number
        assert held == dict(zip(sizes, demand, strict=True))
    same = spark.createDataFrame([(None if i < 3 else 7, "one two three", 1) for i in range(200)], "doc_id long, text string, length int")
    rows = packing.pack_documents(same, q_packing.vocabulary_path()).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 200
    assert packing.pack_documents(same.limit(0), q_packing.vocabulary_path()).count() == 0


def test_mined_rules_of_long_templates(spark):
    """A template of 40 words is one item: no set of its words is grown, and each of its words alone is a rule."""
    template = [f"word:t{i:02}" for i in range(40)]
    rows = [(template + ["host:bad", f"word:only{i}"], True) for i in range(40)] + [(["host:good", "word:a"], False)] * 60
    rows += [(["host:mixed", "word:a"], i % 2 == 0) for i in range(40)]
    rules = url_rules.mined_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean"))
    assert sorted(rules) == sorted([t] for t in [*template, "host:bad"])


def test_every_token_of_a_url(spark):
    url = "http://a.b.c.d.e.f/" + "/".join(f"{chr(97 + i)}x" for i in range(12)) + "?" + "&".join(f"k{i}=1" for i in range(12))
    tokens = url_rules.with_parts(spark.createDataFrame([(url,)], "url string")).first()["tokens"]
    assert [sum(t.startswith(kind) for t in tokens) for kind in ("host:", "word:", "key:")] == [6, 12, 12]

"""URL filtering: fixed host and path rules first, mined association rules for the rest.

A URL becomes a set of tokens: host suffixes, words of the host's labels and of
the path, language-like first path parts, file endings and query keys. Spark's
FP-growth mines frequent token sets from labelled URLs; a set whose share of
bad URLs (confidence) and number of labelled URLs (support) are high enough
becomes a blocking rule, and a rule whose subset is already a rule is dropped.
Mined rules are matched by an inverted index: each rule is stored under its
longest token and compared only with URLs that carry that token.

Defined cases: a null URL or one without ``://`` has an empty host and path, no
tokens and is allowed by the method; labels that are null or point to no URL
are left out of mining; without labelled URLs nothing is mined; repeated rows
are judged and, if labelled, counted each; a URL of any length or number of
words and keys gives all its tokens; an empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.tables import lowered, stored

# A rule needs MIN_SHARE of the labelled URLs.
MIN_SHARE = 0.005
MIN_COUNT = 20
MIN_CONFIDENCE = 0.9


@dataclass(frozen=True)
class Rule:
    """``pattern`` is host and path, as in ``example.org/es/``."""

    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return lowered(host), path


def with_parts(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host``, ``path`` and ``tokens`` (distinct strings)."""
    host, path = host_and_path(F.col(url_col).cast("string"))
    parts = urls.withColumn("host", host).withColumn("path", path)
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.concat(F.lit("host:"), F.array_join(F.slice(labels, -n, n), ".")),
    )
    words = F.array_distinct(F.regexp_extract_all(lowered(F.col("path")), F.lit(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"), 0))
    query = F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"\?([^#]*)", 1)
    keys = F.array_distinct(F.regexp_extract_all(query, F.lit(r"(?:^|&)([^=&]+)"), 1))
    ending = F.regexp_extract("path", r"\.([A-Za-z0-9]{1,5})$", 1)
    tokens = F.concat(
        suffixes,
        F.transform(words, lambda w: F.concat(F.lit("word:"), w)),
        F.transform(keys, lambda k: F.concat(F.lit("key:"), k)),
        F.when(ending != "", F.array(F.concat(F.lit("end:"), ending))).otherwise(F.array().cast("array<string>")),
    )
    return parts.withColumn("tokens", F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(F.array_distinct(tokens)))


def mined_rules(labelled: DataFrame, min_share: float = MIN_SHARE, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE) -> list[list[str]]:
    """Token sets that mark bad URLs, from rows of ``tokens`` and boolean ``bad``.

    FP-growth runs over the whole labelled table. Tokens that stand in exactly
    the same labelled URLs (by count and 64-bit hash of the rows) are mined as
    one, so a template of many words adds one item and not all its subsets; a
    rule of one such token is a rule for each of them. The pruned rule list
    comes back to the driver.
    """
    spark = labelled.sparkSession
    rows = labelled.filter(F.col("bad").isNotNull() & (F.size("tokens") > 0))
    baskets = stored(rows.select(F.monotonically_increasing_id().alias("row"), F.array_distinct("tokens").alias("items"), "bad"), "url-baskets")
    counts = baskets.agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad")).first()
    if not counts["n"] or not counts["bad"]:
        return []
    support = max(min_share, min_count / counts["n"])
    if support > 1:
        return []
    each = baskets.select("row", "bad", F.explode("items").alias("token"))
    tokens = each.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("row")).alias("rows")).filter(F.col("n") >= support * counts["n"] - 1e-6)
    twins = stored(tokens.withColumn("item", F.min("token").over(Window.partitionBy("n", "rows"))).select("token", "item"), "url-twins")
    items = each.join(twins.filter("token = item").select("token"), "token").groupBy("row", "bad").agg(F.collect_list("token").alias("items"))
    baskets = stored(items, "url-items")
    # A rule is a set that is frequent together with the label, so sets are grown among bad rows only ...
    among_bad = baskets.filter("bad").select("items")
    least, held = support * counts["n"], among_bad.count()
    if held < least - 1e-6:
        return []
    grown = FPGrowth(itemsCol="items", minSupport=min(1.0, least / held)).fit(among_bad).freqItemsets
    sets = [(r["items"], r["freq"]) for r in grown.select(F.array_sort("items").alias("items"), "freq").toLocalIterator()]
    if not sets:
        return []
    # ... and counted among all rows through the index of their first tokens.
    schema = T.StructType([T.StructField("rule", T.IntegerType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("freq", T.LongType())])
    candidates = spark.createDataFrame([(i, s, f) for i, (s, f) in enumerate(sets)], schema)
    hits = (
        baskets.withColumn("token", F.explode("items"))
        .join(F.broadcast(candidates.select("rule", "freq", F.col("items").alias("wanted"), F.element_at("items", 1).alias("token"))), "token")
        .filter(F.size(F.array_except("wanted", "items")) == 0)
        .groupBy("rule", "freq").agg(F.count("*").alias("n"))
        .filter(F.col("freq") >= min_confidence * F.col("n"))
    )
    good = sorted((sets[r["rule"]][0] for r in hits.collect()), key=lambda s: (len(s), s))
    kept: list[list[str]] = []
    for items in good:
        if not any(set(k) <= set(items) for k in kept):
            kept.append(items)
    alone = [items[0] for items in kept if len(items) == 1]
    same = twins.filter(F.col("item").isin(alone) & (F.col("token") != F.col("item"))).select("token").collect() if alone else []
    return kept + sorted([r["token"]] for r in same)


def judged(urls: DataFrame, fixed: list[Rule], mined: list[list[str]]) -> DataFrame:
    """Adds ``rule`` (pattern of the longest fitting fixed rule or null) and ``verdict``."""
    fitting = F.lit(None).cast("string")
    verdict = F.lit(None).cast("string")
    for rule in sorted(fixed, key=lambda r: (len(r.pattern), r.pattern)):  # the longest is asked first
        fits = ((F.col("host") == rule.host) | F.endswith(F.col("host"), F.lit("." + rule.host))) & F.startswith(F.col("path"), F.lit(rule.path))
        fitting = F.when(fits, F.lit(rule.pattern)).otherwise(fitting)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    index: dict[str, list[list[str]]] = {}
    for items in mined:
        index.setdefault(max(items, key=len), []).append(items)  # long tokens are rare
    blocked = F.lit(False)
    if index:
        entries = []
        for token, rules in sorted(index.items()):
            entries += [F.lit(token), F.array(*(F.array(*map(F.lit, r)) for r in rules))]
        table = F.create_map(*entries)
        blocked = F.exists(
            "tokens",
            lambda t: F.coalesce(F.exists(F.element_at(table, t), lambda r: F.size(F.array_except(r, F.col("tokens"))) == 0), F.lit(False)),
        )
    return urls.withColumn("rule", fitting).withColumn(
        "verdict", F.coalesce(verdict, F.when(blocked, F.lit("block")).otherwise(F.lit("allow")))
    )

"""URL filters: listed rules first, mined association rules for the rest.

Spark's FP-growth mines frequent combinations of URL tokens together with the
label of the URL. A combination becomes a rule for its more frequent label if
its support and confidence suffice and no part of it says the same as surely.
Before mining, tokens that stand in exactly the same URLs become one, and tokens
that no combination can gain from are set aside: see ``_frequent_classes``.
Rules are matched by an inverted index from tokens to rules: only rules that
share a token with the URL are looked at, and one holds once all its tokens
have been met.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import append, strings
from tierflow.staging import stage

LABEL = "label="


def _ascii_lower(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#``; A-Z lower-cased."""
    return _ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    found = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


@dataclass(frozen=True)
class ListedRule:
    """A verdict for a host, its subdomains, and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @classmethod
    def parse(cls, text: str) -> ListedRule:
        verdict, place = text.split(" ", 1)
        host, slash, path = place.partition("/")
        return cls(verdict, host.lower(), slash + path)

    def fits(self, host: Column, path: Column) -> Column:
        same = (host == self.host) | host.endswith("." + self.host)
        return same & path.startswith(self.path)


def listed_verdict(rules: list[ListedRule], host: Column, path: Column) -> Column:
    """The longest rule that fits as (rule, verdict), or null; of equal ones the first."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        found = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        chosen = F.when(rule.fits(host, path), found).otherwise(chosen)
    return chosen


def url_tokens(url: Column) -> Column:
    """Distinct tokens: labels of the host, words of path and query, numbers as one token."""
    host, path = url_host(url), url_path(url)
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)

    def tokens(text: Column, mark: str) -> Column:
        words = F.regexp_extract_all(_ascii_lower(text), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))
        words = F.transform(words, lambda w: F.regexp_replace(w, r"^\p{N}+$", "<n>"))
        return F.transform(words, lambda w: F.concat(F.lit(mark), w))

    every = F.concat(tokens(host, "h:"), tokens(path, "p:"), tokens(query, "q:"))
    return F.coalesce(F.array_distinct(every), F.array().cast("array<string>"))


@dataclass(frozen=True)
class MinedRule:
    """``verdict`` holds where each of ``tokens``, or one that it ``stands_for``, occurs.

    ``stands_for`` has the tokens that occurred in exactly the same labelled URLs
    as one of ``tokens``, by that token: the rule is one for each choice of them.
    """

    tokens: frozenset[str]
    verdict: str
    confidence: float
    support: float
    stands_for: tuple[tuple[str, tuple[str, ...]], ...] = ()

    def rank(self) -> tuple:
        """Surer rules first, then better supported, then shorter ones."""
        return -self.confidence, -self.support, len(self.tokens), sorted(self.tokens), self.verdict

    def choices(self) -> list[set[str]]:
        """For each of ``tokens`` those that may stand in its place, itself among them."""
        others = dict(self.stands_for)
        return [{t, *others.get(t, ())} for t in sorted(self.tokens)]


@dataclass(frozen=True)
class _TokenClass:
    """Tokens of exactly the same labelled URLs: how many these are, by label and in all."""

    tokens: list[str]
    labels: dict[str, int]
    count: int


def mine_rules(
    labelled: DataFrame,
    url: str = "url",
    label: str = "label",
    min_support: float = 0.01,
    min_confidence: float = 0.8,
) -> list[MinedRule]:
    """Rules from the labels of URLs; all labelled rows count.

    Every frequent combination of tokens may make a rule, whatever its length,
    and none but the redundant ones are left out. Work grows with combinations of
    tokens that occur in different sets of URLs, under more than one label;
    however many tokens URLs share beyond that, they count as one. Rows without
    URL or label teach nothing; without any there are no rules.
    """
    rows = labelled.where(f"{url} IS NOT NULL AND {label} IS NOT NULL").select(
        url_tokens(F.col(url)).alias("tokens"),
        F.concat(F.lit(LABEL), F.col(label).cast("string")).alias("label"),
    )
    rows, _ = stage(rows, "labelled-urls")
    total = rows.count()
    if not total:
        return []
    least = math.ceil(min_support * total)
    classes = _frequent_classes(rows, least)
    found = [
        ((c.tokens[0],), label, n / c.count, n / total)
        for c in classes
        for label, n in c.labels.items()
        if n >= least and n / c.count >= min_confidence
    ]
    # What one more token can make surer: not what is sure, nor what is in all URLs.
    open_ = [c.tokens[0] for c in classes if c.count < total and max(c.labels.values()) < c.count]
    if len(open_) > 1:
        items = F.array_intersect("tokens", F.array(*map(F.lit, open_)))
        mined = FPGrowth(itemsCol="items", minSupport=min_support).fit(
            rows.select(F.concat(items, F.array("label")).alias("items"))
        )
        rules, depth = _label_rules(mined.freqItemsets, total)
        found += map(tuple, _not_redundant(rules, depth, min_confidence).collect())
    others = {c.tokens[0]: tuple(c.tokens[1:]) for c in classes if len(c.tokens) > 1}
    return sorted(
        (
            MinedRule(
                frozenset(tokens),
                label[len(LABEL) :],
                confidence,
                support,
                tuple((t, others[t]) for t in sorted(tokens) if t in others),
            )
            for tokens, label, confidence, support in found
        ),
        key=MinedRule.rank,
    )


def _frequent_classes(rows: DataFrame, least: int) -> list[_TokenClass]:
    """Tokens that ``least`` rows of one label have, gathered by the rows they occur in.

    Rows are told apart by hashes of their token lists, summed by token: two tokens
    are of one class if they are in as many rows and two sums of 64-bit hashes agree.
    As 1 / support tokens of a URL's length are frequent at most, their number does
    not grow with rows.

    A combination with two tokens of a class, or one token that is in all rows, is
    met in the same rows without it. One with a token that has a single label
    cannot be surer than that token. So no such combination makes a rule.
    """
    hashes = [F.xxhash64("tokens", F.lit(seed)).cast("decimal(38,0)") for seed in (1, 2)]
    each = rows.select(F.explode("tokens").alias("token"), "label", *[h.alias(f"h{i}") for i, h in enumerate(hashes)])
    counted = each.groupBy("token", "label").agg(
        F.count("*").alias("n"), F.sum("h0").alias("h0"), F.sum("h1").alias("h1")
    )
    frequent = (
        counted.groupBy("token")
        .agg(
            F.sum("n").alias("count"),
            F.sum("h0").alias("h0"),
            F.sum("h1").alias("h1"),
            F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("labels"),
            F.max("n").alias("most"),
        )
        .where(F.col("most") >= least)
    )
    classes: dict[tuple, _TokenClass] = {}
    for r in frequent.orderBy("token").collect():
        one = classes.setdefault((r["count"], r["h0"], r["h1"]), _TokenClass([], r["labels"], r["count"]))
        one.tokens.append(r["token"])
    return list(classes.values())


def _label_rules(itemsets: DataFrame, total: int) -> tuple[DataFrame, int]:
    """``tokens`` (sorted), ``label``, ``confidence`` and ``support`` of all, and the longest size."""
    labels = F.filter("items", lambda x: x.startswith(LABEL))
    tokens = F.array_sort(F.filter("items", lambda x: ~x.startswith(LABEL)))
    split = itemsets.select(tokens.alias("tokens"), F.get(labels, F.lit(0)).alias("label"), "freq").where(
        F.size("tokens") > 0
    )
    split, _ = stage(split, "itemsets")
    without = split.where("label IS NULL").select("tokens", F.col("freq").alias("of"))
    rules = split.where("label IS NOT NULL").join(without, "tokens")
    rules = rules.select(
        "tokens",
        "label",
        (F.col("freq") / F.col("of")).alias("confidence"),
        (F.col("freq") / F.lit(total)).alias("support"),
        F.size("tokens").alias("n"),
    )
    rules, _ = stage(rules, "rules")
    return rules, rules.agg(F.max("n")).first()[0] or 0


def _not_redundant(rules: DataFrame, depth: int, min_confidence: float) -> DataFrame:
    """Rules of ``min_confidence`` and of two tokens or more, surer than each part of theirs.

    All parts of a frequent combination are frequent, so the surest part of one
    is found among those with one token less and what was the surest in them.
    """
    levels = [rules.where("false").select("tokens", "label", "confidence", "support")]
    surest = rules.where("n = 1").select("tokens", "label", F.col("confidence").alias("surest"))
    for n in range(2, depth + 1):
        parts = rules.where(F.col("n") == n).select(
            "tokens",
            "label",
            "confidence",
            "support",
            F.explode(F.transform("tokens", lambda x: F.array_remove("tokens", x))).alias("part"),
        )
        below = surest.select(F.col("tokens").alias("part"), "label", "surest")
        level = parts.join(below, ["part", "label"]).groupBy("tokens", "label", "confidence", "support")
        level, _ = stage(level.agg(F.max("surest").alias("below")), "rules-of-a-size")
        levels.append(
            level.where((F.col("confidence") >= min_confidence) & (F.col("confidence") > F.col("below"))).drop("below")
        )
        surest = level.select("tokens", "label", F.greatest("confidence", "below").alias("surest"))
    return reduce(DataFrame.unionByName, levels)


class RuleIndex:
    """Inverted index: the best rule whose tokens all occur."""

    def __init__(self, rules: list[MinedRule], default: str):
        self.rules, self.default = rules, default
        self.sizes = [len(r.tokens) for r in rules]
        # Token to (rule, place): tokens that stand for each other share a place.
        self.postings: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, rule in enumerate(rules):
            for place, choice in enumerate(rule.choices()):
                for token in choice:
                    self.postings[token].append((i, place))

    def verdict(self, tokens: set[str]) -> str:
        met: dict[int, set[int]] = defaultdict(set)
        best = len(self.rules)
        for token in tokens:
            for i, place in self.postings.get(token, ()):
                if i < best:
                    met[i].add(place)
                    if len(met[i]) == self.sizes[i]:
                        best = i
        return self.rules[best].verdict if best < len(self.rules) else self.default


def judge_urls(
    pages: DataFrame,
    listed: list[ListedRule],
    mined: list[MinedRule],
    default: str = "allow",
    url: str = "url",
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to each row; nothing is shuffled.

    ``rule`` is the listed rule that decided, or null where the mined rules, or
    else ``default``, did. A null URL, or one without ``://``, has an empty host
    and path and gets the default, unless mined tokens say otherwise. Columns
    named like the result are replaced, others pass; repeated rows all stay.
    """
    new = {"host", "path", "rule", "verdict", "__tokens", "__mined"}
    kept = [c for c in pages.columns if c.lower() not in new]
    host, path = url_host(F.col(url)), url_path(F.col(url))
    read = pages.select(
        *[F.col(f"`{c}`") for c in kept],
        host.alias("host"),
        path.alias("path"),
        listed_verdict(listed, host, path).alias("__listed"),
        F.array_join(url_tokens(F.col(url)), "\n").alias("__tokens"),
    )
    index = RuleIndex(mined, default)

    def make():
        def step(column: pa.Array) -> list[pa.Array]:
            known: dict[str, str] = {}
            out = []
            for text in strings(column):
                if text not in known:
                    known[text] = index.verdict(set(text.split("\n")))
                out.append(known[text])
            return [pa.array(out, pa.string())]

        return step

    fields = T.StructType([T.StructField("__mined", T.StringType())])
    return append(read, fields, make, "__tokens").select(
        *[F.col(f"`{c}`") for c in kept],
        "host",
        "path",
        F.col("__listed.rule").alias("rule"),
        F.coalesce("__listed.verdict", "__mined").alias("verdict"),
    )

"""URL filter: rules first, then segmented host names scored by naive Bayes.

Host names are split at signs, then each part is segmented into words by Viterbi over a unigram model:
the counts of the words of all pages' texts and, with less weight, of the parts of hosts and paths, in a
hashed table of fixed size, and of the words of the labelled names. Tokens of host and path are scored by
multinomial naive Bayes. It starts from ``EXAMPLES``, names labelled by hand, which a first model learns; that
model labels the table's urls, and the judging model learns each class half from the examples and half from
all urls so labelled (self-training, one round). So no word blocks by itself: a name with one doubtful word among ordinary ones
is allowed, and words that keep doubtful company in the table count too.

A word of the model has at most ``LONGEST`` letters; a longer run of letters is several tokens. Null urls and urls
without ``://`` have an empty host and path; no rule fits them and they are judged by the prior (allowed). An empty table learns
nothing and allows. Null texts have no words. Repeated rows repeat.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import pick

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
BUCKETS = 1 << 16
LONGEST = 20
PART_WEIGHT = 0.005
TEXT_WEIGHT = 0.02
THRESHOLD = 0.5
SMOOTH = 0.1
LIKELY = float(np.log(0.1 / 0.9))  # log odds of block before anything is known
#: names labelled by hand, as words: fixed training data
EXAMPLES = {
    "block": (
        "free casino", "casino win", "win casino bonus", "casino slots online", "slots jackpot", "jackpot spins", "poker bonus", "poker cash",
        "online betting", "free bets", "bets tips", "sports betting odds", "bet now", "bingo win cash", "lottery winner", "lottery prize win",
        "cheap pills", "pills online", "cheap pharmacy", "pharmacy pills", "viagra pills", "cheap viagra", "pharma cheap", "replica cheap",
        "cash loan", "payday loan", "fast cash loans", "loans bonus", "gamble online", "gambling win", "adult sex", "sex porn", "porn xxx",
        "free porn", "adult xxx", "escort sex", "torrent crack", "crack keygen", "keygen warez", "free warez", "hack crack", "virus spam",
        "ads tracker", "ads banner", "banner track", "track ads", "tracking pixel", "click track", "clickbait ads", "spam farm", "free prize",
        "cheap replica", "bonus cash", "deals cheap cash",
    ),
    "allow": (
        "free garden guide", "free library", "free school books", "free music lessons", "cheap travel guide", "track and field club",
        "running track", "race track news", "farm shop", "farm life", "family farm", "organic farm food", "prize for science", "book prize",
        "win at work", "winter sport", "holiday deals travel", "money and work", "adult education", "adult learning school", "virus research lab",
        "city library", "garden club", "music school", "travel blog", "food market", "sport club", "health guide", "home garden design",
        "history of art", "photo studio", "news online", "local news", "school project", "science forum", "book club", "open project",
        "learn design", "house and home", "video studio", "story time", "team sport", "car market", "job market", "city map", "the daily post",
        "my blog", "web design", "tech news", "world news", "tour guide", "press media", "community forum", "trade school", "day tour",
    ),
}
#: further ordinary words, so that names split where people would
COMMON = (
    "a about all an best big business buy by com edu en first for game go good help hour how in info international is it items list net "
    "new of on one org our page plan play site social solutions store to today top tv up us video wiki you your"
).split()
_LISTED = frozenset([w for names in EXAMPLES.values() for n in names for w in n.split()] + COMMON)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


def _by_bucket(words: DataFrame) -> np.ndarray:
    """Counts of the words ``w`` by bucket."""
    counts = np.zeros(BUCKETS)
    got = words.groupBy(F.pmod(F.crc32(F.col("w").cast("binary")), F.lit(BUCKETS)).cast("int").alias("b")).count()
    for row in got.collect():  # BUCKETS rows at most
        counts[row["b"]] = row["count"]
    return counts


def unigram_costs(urls: DataFrame, texts: DataFrame | None) -> np.ndarray:
    """Negative log probabilities by bucket of a word: from all words of ``texts`` (column ``html``) and all
    parts of all hosts and paths; the labelled names' words have a count of their own."""
    parts = urls.select(F.explode(F.split(F.lower(F.concat_ws("/", "host", "path")), "[^a-z]+")).alias("w")).filter("w <> ''")
    counts = 1e-3 + PART_WEIGHT * np.log1p(_by_bucket(parts))  # a part of a name that's a word is rarer than its words
    if texts is not None:
        plain = F.lower(F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<(script|style)\b.*?</\1\s*>|<[^>]*>", " "))
        words = texts.select(F.explode(F.split(plain, r"[^\p{L}]+")).alias("w")).filter(F.length("w").between(2, LONGEST))
        counts += TEXT_WEIGHT * np.log1p(_by_bucket(words))
    for word in sorted(_LISTED):
        counts[bucket(word)] += 50
    return -np.log(counts / counts.sum())


class Segmenter:
    """Unigram Viterbi over a name's letters."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs.tolist()
        self.split = lru_cache(maxsize=100_000)(self._split)

    def _split(self, name: str) -> tuple[str, ...]:
        best, back = [0.0] + [float("inf")] * len(name), [0] * (len(name) + 1)
        for j in range(1, len(name) + 1):
            for i in range(max(0, j - LONGEST), j):
                word = name[i:j]
                # words outside the lists cost more the longer they are, so compounds come apart
                cost = best[i] + self.costs[bucket(word)] + 2.0 / (j - i) + (0.0 if word in _LISTED else 0.5 * (j - i))
                if cost < best[j]:
                    best[j], back[j] = cost, i
        out, j = [], len(name)
        while j:
            out.append(name[back[j]:j])
            j = back[j]
        return tuple(out[::-1])

    def tokens(self, host: str, path: str) -> list[str]:
        """Words of the host, prefixed h:, and of the path, prefixed p:; numbers don't count."""
        out = []
        for mark, text in (("h:", host.rpartition(".")[0]), ("p:", path.lower())):
            for part in re.findall(r"[^\W\d_]+", text):
                out += [mark + w for w in self.split(part)]
        return out


def _shares(counts: np.ndarray) -> np.ndarray:
    """Smoothed token probabilities by class."""
    seen = max(1, int((counts.sum(0) > 0).sum()))
    return (counts + SMOOTH) / (counts.sum(1, keepdims=True) + SMOOTH * seen)


def first_weights() -> np.ndarray:
    """Log odds of block by bucket, from the examples alone."""
    share = _shares(labelled_counts())
    return np.log(share[1] / share[0])


def final_weights(counts: np.ndarray) -> np.ndarray:
    """Log odds of block by bucket, half from the examples and half from the table's urls; a class without any
    url has what all urls have."""
    own = np.where(counts.sum(1, keepdims=True) > 0, counts, counts.sum(0))
    share = _shares(labelled_counts()) + _shares(own)
    return np.log(share[1] / share[0])


def labelled_counts() -> np.ndarray:
    """Token counts of EXAMPLES by class and bucket; a name may be host or path."""
    counts = np.zeros((2, BUCKETS))
    for y, label in enumerate(("allow", "block")):
        for word in " ".join(EXAMPLES[label]).split():
            for mark in ("h:", "p:"):
                counts[y, bucket(mark + word)] += 1
    return counts


def class_counts(urls: DataFrame, costs: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Token counts of all urls by bucket and the class that a model gives them; class 1 is block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(costs)
        totals = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for host, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = [bucket(t) for t in segmenter.tokens(host, path)]
                np.add.at(totals[int(LIKELY + weight[at].sum() > 0)], at, 1)
        y, b = np.nonzero(totals)
        if len(y):
            yield pa.RecordBatch.from_arrays(
                [pa.array(y.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(totals[y, b])], names=["y", "b", "n"])

    got = urls.select("host", "path").mapInArrow(count, "y int, b int, n long").groupBy("y", "b").agg(F.sum("n").alias("n"))
    totals = np.zeros((2, BUCKETS))
    for row in got.collect():  # 2 x BUCKETS rows at most
        totals[row["y"], row["b"]] = row["n"]
    return totals


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str | None = "html", rules=RULES) -> DataFrame:
    """Per row: id, host, path, rule, verdict, block_score (naive Bayes' probability of block)."""
    host, path = host_and_path(F.col("url_"))
    urls = pick(pages, id_col, url_col).toDF("id_", "url_").select("id_", host.alias("host"), path.alias("path"))
    texts = pick(pages, html_col).toDF("html") if html_col else None
    costs = unigram_costs(urls, texts)
    weight = final_weights(class_counts(urls, costs, first_weights()))

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        segmenter = Segmenter(costs)
        for hosts, paths in batches:
            logit = [LIKELY + weight[[bucket(t) for t in segmenter.tokens(h, p)]].sum() for h, p in zip(hosts, paths)]
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(logit, float), -30, 30))))

    rows = urls.select("id_", "host", "path", rule_for(F.col("host"), F.col("path"), rules).alias("r"), score("host", "path").alias("block_score"))
    method = F.when(F.col("block_score") >= THRESHOLD, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(F.col("id_").alias(id_col), "host", "path", F.col("r.rule").alias("rule"),
                       F.coalesce("r.verdict", method).alias("verdict"), "block_score")

"""URL verdicts: host and path rules first, and a logistic regression on character n-grams for the rest."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
SIZES = (2, 3, 4, 5)
#: Rows of the labelled table at most, and rules at most: both travel with the plan.
MAX_LABELLED, MAX_RULES = 5000, 200

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: The default labelled table is made of these: general names of sites to block, of sites to allow, and common forms of URLs.
BLOCK_NAMES = [
    "casino", "poker", "jackpot", "slots", "bets", "betting", "lottery", "winbig", "free-spins", "pills", "cheap-meds", "viagra",
    "pharma-deal", "diet-pills", "replica", "fake-watches", "adult", "xxx", "porn", "sex-cams", "escort", "hot-girls", "spam",
    "link-farm", "ad-click", "adserver", "tracker", "popups", "click-bait", "payday-loan", "quick-loans", "free-money",
    "get-rich", "crypto-giveaway", "torrent", "warez", "cracked", "keygen", "phish", "malware", "virus-scan", "scam",
]
ALLOW_NAMES = [
    "news", "library", "museum", "university", "school", "research", "weather", "science", "history", "journal", "garden",
    "kitchen", "travel", "sports", "music", "theatre", "books", "forum", "docs", "wiki", "health", "council", "village",
    "river", "mountain", "bicycle", "chess", "radio", "photos", "recipes", "the-daily", "open-data", "city-hall", "bird-watch",
    "physics", "handmade", "orchestra", "bakery", "gallery", "railway", "poetry", "cinema",
]
LABEL_FORMS = ["https://{}.com/", "http://www.{}.net/index.html", "https://{}.org/about", "https://shop.{}.info/item/77?ref=x"]


@dataclass(frozen=True)
class Rule:
    """`text` is a host and then a path, such as example.org/en/; it fits that host and its subdomains."""

    action: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def url_host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.translate(F.regexp_extract(_after(url), r"^([^/?#]*)", 1), CAPITALS, CAPITALS.lower())


def url_path(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")


def _fitting(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """(text, action) of the longest rule that fits, the first of equally long ones; null if none does."""
    found = F.lit(None).cast("struct<text:string,action:string>")
    for rule in sorted(rules, key=lambda r: -len(r.text))[::-1]:
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.action).alias("action"))).otherwise(found)
    return found


def features(host: str, path: str) -> np.ndarray:
    """Buckets of the distinct n-grams of a host and of a path, each with its borders."""
    grams = set()
    for kind, text in ((b"h", host), (b"p", path)):
        raw = b"^" + text.encode("utf-8", "surrogatepass") + b"$" if text else b""
        grams.update(kind + raw[k : k + n] for n in SIZES for k in range(len(raw) - n + 1))
    return np.unique(np.fromiter((zlib.crc32(g) % BUCKETS for g in grams), dtype=np.int64, count=len(grams)))


@dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    bias: float

    def probability(self, host: str, path: str) -> float:
        """That a URL is one to block."""
        own = features(host, path)
        score = self.bias + (self.weights[own].sum() / np.sqrt(len(own)) if len(own) else 0.0)
        return float(1 / (1 + np.exp(-score)))


def fit_urls(rows: Sequence[tuple[str, str, int]], rounds: int = 300, rate: float = 0.5, decay: float = 1e-3) -> UrlModel:
    """Logistic regression from (host, path, label) rows, label 1 being block; an empty table gives a model that allows all."""
    if not rows:
        return UrlModel(np.zeros(BUCKETS), -1.0)
    own = [features(host, path) for host, path, _ in rows]
    at = np.repeat(np.arange(len(own)), [len(x) for x in own])
    bucket = np.concatenate(own)
    value = 1 / np.sqrt(np.maximum(1, np.bincount(at, minlength=len(own))))[at]
    label = np.array([y for *_, y in rows], dtype=float)
    weights, bias = np.zeros(BUCKETS), 0.0
    for _ in range(rounds):
        score = bias + np.bincount(at, weights=weights[bucket] * value, minlength=len(own))
        gap = 1 / (1 + np.exp(-score)) - label
        slope = np.bincount(bucket, weights=gap[at] * value, minlength=BUCKETS) / len(own)
        weights -= rate * len(own) ** 0.5 * (slope + decay * weights / len(own))
        bias -= rate * gap.mean()
    return UrlModel(weights, bias)


def labelled_urls(spark, path: str | None = None) -> DataFrame:
    """A small labelled table (url, label), label 1 for sites to block: that at `path`, Parquet or .csv with a header, or the default."""
    if path is not None:
        rows = spark.read.csv(path, header=True, escape='"') if path.endswith(".csv") else spark.read.parquet(path)
        return rows.select(F.col("url").cast("string"), F.col("label").cast("int"))
    rows = [(form.format(name), label) for names, label in ((BLOCK_NAMES, 1), (ALLOW_NAMES, 0)) for name in names for form in LABEL_FORMS]
    return spark.createDataFrame(rows, "url string, label int")


def train_url_model(labelled: DataFrame) -> UrlModel:
    """A model from a small labelled table (url, label); more than MAX_LABELLED usable rows are an error."""
    rows = labelled.where("label IN (0, 1)").select(url_host(F.col("url")), url_path(F.col("url")), "label")
    found = rows.orderBy(*rows.columns).limit(MAX_LABELLED + 1).collect()
    if len(found) > MAX_LABELLED:
        raise ValueError(f"the labelled table has more than {MAX_LABELLED} rows")
    return fit_urls([tuple(row) for row in found])


def url_verdicts(pages: DataFrame, rules: Sequence[Rule], model: UrlModel, threshold: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) per row; page_id and url are read.

    The longest rule that fits decides, and where none fits the model: block from `threshold` on. A null url or one without
    :// has an empty host and path, which no rule fits, and the model judges it by its bias alone. Repeated rows and rows
    without a page_id are judged as they come. An empty table gives an empty result.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    shared = pages.sparkSession.sparkContext.broadcast(model)  # BUCKETS doubles

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in batches:
            yield pd.Series([shared.value.probability(h, p) for h, p in zip(hosts, paths, strict=True)], dtype=float)

    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), url_host(url).alias("host"), url_path(url).alias("path"))
    rows = rows.withColumn("score", score("host", "path")).withColumn("found", _fitting(rules, F.col("host"), F.col("path")))
    modelled = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return rows.select(
        "page_id", "host", "path", F.col("found.text").alias("rule"), F.coalesce("found.action", modelled).alias("verdict"), "score"
    )

"""URL filters: host and path rules, and logistic regression on hashed character n-grams.

Everything is DataFrame expressions and Spark's own ML stages; no Python runs on the executors.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free, stored, without_summary

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """Fits a host with its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Learning:
    """How the classifier is trained. ``max_labelled`` bounds its table: the urls of least hash."""

    max_labelled: int = 20_000
    n_grams: Sequence[int] = (3, 4)
    features: int = 1 << 14
    regularization: float = 0.001
    iterations: int = 50


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without a ``://``."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null where none does.

    Of rules of one length the first by code point counts, so the order of the list does not.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _grams(part: Column, mark: str, sizes: Sequence[int]) -> Column:
    """Overlapping n-grams of a part with its ends marked, found by look-ahead in one pass each."""
    whole = F.concat(F.lit("^"), part, F.lit("$"))
    found = [F.regexp_extract_all(whole, F.lit(f"(?s)(?=(.{{{n}}}))"), 1) for n in sizes]
    return F.transform(F.flatten(F.array(*found)), lambda g: F.concat(F.lit(mark), g))


def features(df: DataFrame, host: str, path: str, out: str, learning: Learning) -> DataFrame:
    """``df`` with a sparse vector of hashed n-gram counts of host and path."""
    grams = free(df, "__grams")
    terms = df.withColumn(grams, F.concat(_grams(F.col(host), "h", learning.n_grams), _grams(F.col(path), "p", learning.n_grams)))
    return HashingTF(numFeatures=learning.features, inputCol=grams, outputCol=out).transform(terms).drop(grams)


def train(labelled: DataFrame, learning: Learning = Learning()) -> LogisticRegressionModel | None:
    """A classifier from (host, path, verdict); None if the table lacks one of the verdicts.

    Repeated urls count once; beyond ``max_labelled`` those of least hash are taken, so the choice
    does not depend on the order of rows. One partition makes sums, and so reruns, agree.
    """
    few = (
        labelled.where(F.col("verdict").isin(ALLOW, BLOCK)).groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
        .orderBy(F.xxhash64("host", "path"), "host", "path").limit(learning.max_labelled))
    few = stored(few.withColumn("label", (F.col("verdict") == BLOCK).cast("double")).coalesce(1), "labelled")
    if few.select("verdict").distinct().count() < 2:
        return None
    return without_summary(LogisticRegression(
        featuresCol="terms", regParam=learning.regularization, maxIter=learning.iterations,
    ).fit(features(few, "host", "path", "terms", learning).select("terms", "label")), labelled.sparkSession)


def judge(df: DataFrame, rules: Sequence[Rule], url: str = "url", keep: Sequence[str] = ("page_id",),
          labelled: DataFrame | None = None, learning: Learning = Learning()) -> DataFrame:
    """Host, path, fitting rule and verdict of each url beside the ``keep`` columns.

    A url that a rule fits gets its verdict, any other the classifier's. It is trained on
    ``labelled`` (host, path, verdict), by default on the urls of ``df`` that the rules judge, in
    either case a bounded number. Scoring is row by row; nothing is shuffled but the labelled urls.

    Null urls and urls without ``://`` have an empty host and path and are judged by the classifier.
    If it has nothing to learn from (no labelled urls, or of one verdict only) such urls are allowed.
    Repeated rows are judged each alone, urls of any length whole. A kept column named like an added
    one (host, path, rule, verdict) is dropped.
    """
    keep = [c for c in keep if c.lower() not in ("host", "path", "rule", "verdict")]
    parts = df.select(*(F.col(f"`{c}`") for c in keep), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    text, verdict = fitting(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumn("rule", text).withColumn("verdict", verdict)
    model = train(ruled if labelled is None else labelled, learning)
    if model is None:
        return ruled.withColumn("verdict", F.coalesce("verdict", F.lit(ALLOW)))
    terms, guess, odds, chance = (free(ruled, f"__{c}") for c in ("terms", "guess", "odds", "chance"))
    model = model.setFeaturesCol(terms).setPredictionCol(guess).setRawPredictionCol(odds).setProbabilityCol(chance)
    scored = model.transform(features(ruled, "host", "path", terms, learning))
    learnt = F.when(F.col(guess) > 0, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.select(*(F.col(f"`{c}`") for c in keep), "host", "path", "rule", F.coalesce("verdict", learnt).alias("verdict"))

"""Keyword-stuffed pages, link lists and tag lists.

Every figure is counted in one pass over the texts; only hashes of phrases travel. No list of words is used:
a page is judged by how its own words, word pairs and phrases repeat, by how dense its links, tags, separators
and sentence ends are, and by how many of its phrases other hosts carry. What these mean is learnt from labels.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.session import busy, cut, shuffled, small_side

LINK = r"(?:https?://|www\.)[^\s)\]>\"']+"
TAG = r"#[\p{L}\p{N}_]+"
MARKUP = r"<[^<>]*>"
WORD = r"[\p{L}\p{N}]+"
SENTENCE_END = r"[.!?…。！？][\"'\p{Pf}\p{Pe}]*(?:\s+[\"'\p{Pi}\p{Ps}]*[\p{Lu}\p{Lt}\p{Lo}]|\s*(?:[\n\r]|$))"
SEPARATOR = r"(?<=[\p{L}\p{N}])\s*[\n\r|,;/•·>]"
FEATURES = ("link_share", "tag_share", "word_variety", "pair_variety", "phrase_variety", "sentence_words", "end_share", "separator_share", "log_units", "elsewhere_share")


def _variety(found: Column, distinct: Column) -> Column:
    """Distinct members per member; an empty list varies fully."""
    return F.coalesce(F.try_divide(F.size(distinct).cast("double"), F.size(found)), F.lit(1.0))


def page_features(df: DataFrame, text: str, size: int = 5) -> DataFrame:
    """Adds ``_phrases`` (hashes of the distinct runs of ``size`` words) and the features but ``elsewhere_share``; null is an empty text.

    Shares are of a page's units, which are its words, links and hash tags: ``link_share``, ``tag_share``,
    ``end_share`` (ends of sentences: a stop before a capital, a caseless letter or a line end) and
    ``separator_share`` (line ends, commas, bars and the like behind a word). ``sentence_words`` is the
    logarithm of the words a sentence. ``word_variety``, ``pair_variety`` and ``phrase_variety`` are the share of distinct
    ones among the page's words, neighbouring pairs and phrases. ``log_units`` is the logarithm of the units.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    out = df.withColumns({"_plain": F.regexp_replace(body, f"{MARKUP}|{LINK}|{TAG}", " "), "_links": F.regexp_count(body, F.lit(LINK)), "_tags": F.regexp_count(body, F.lit(TAG))})
    out = out.withColumns(
        {
            "_words": F.transform(F.regexp_extract_all(F.lower("_plain"), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)),
            "_ends": F.regexp_count("_plain", F.lit(SENTENCE_END)),
            "_separators": F.regexp_count("_plain", F.lit(SEPARATOR)),
        }
    )

    def runs(n: int) -> Column:
        at = F.sequence(F.lit(0), F.size("_words") - n)
        hashed = F.transform(at, lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(n)]))
        return F.when(F.size("_words") >= n, hashed).otherwise(F.array().cast("array<bigint>"))

    out = out.withColumns({"_pairs": runs(2), "_runs": runs(size)}).withColumn("_phrases", F.array_distinct("_runs"))
    units = F.greatest(F.size("_words") + F.col("_links") + F.col("_tags"), F.lit(1)).cast("double")
    return out.select(
        *df.columns,
        "_phrases",
        (F.col("_links") / units).alias("link_share"),
        (F.col("_tags") / units).alias("tag_share"),
        _variety(F.col("_words"), F.array_distinct("_words")).alias("word_variety"),
        _variety(F.col("_pairs"), F.array_distinct("_pairs")).alias("pair_variety"),
        _variety(F.col("_runs"), F.col("_phrases")).alias("phrase_variety"),
        F.log1p(F.size("_words") / (F.col("_ends") + 1)).alias("sentence_words"),
        (F.col("_ends") / units).alias("end_share"),
        (F.col("_separators") / units).alias("separator_share"),
        F.log1p(units).alias("log_units"),
    )


def phrases_elsewhere(pages: DataFrame, host: str) -> DataFrame:
    """``_row``, ``_shared``: how many of a page's ``_phrases`` two or more hosts carry; pages without any have no row.

    Two hosts carry a phrase if the least and the greatest host (hashed; null is a host of its own) differ,
    one aggregate that is combined map-side, so a phrase on a third of all pages travels as one row per
    task. A phrase on more than one in a hundred thousand of all occurrences is hot; there can be at most
    that many hot ones, so they are broadcast, and no other phrase can crowd a partition of the join.
    """
    found = pages.select("_row", F.coalesce(F.xxhash64(F.col(host)), F.lit(0)).alias("_host"), F.explode("_phrases").alias("_phrase"))
    hosts = found.groupBy("_phrase").agg(F.min("_host").alias("_a"), F.max("_host").alias("_b"), F.count(F.lit(1)).alias("_n"))
    shared = cut(hosts.filter("_a <> _b").select("_phrase", "_n"))
    total = shared.agg(F.sum("_n")).first()[0] or 0
    hot_from = max(10_000, total // 100_000)
    hot, rest = shared.filter(F.col("_n") >= hot_from).select("_phrase", F.lit(True).alias("_hot")), shared.filter(F.col("_n") < hot_from).select("_phrase")
    marked = found.select("_row", "_phrase").join(F.broadcast(hot), "_phrase", "left")
    own = marked.filter("_hot").select("_row")
    met = marked.filter("_hot is null").select("_row", "_phrase").join(shuffled(rest), "_phrase").select("_row")
    return own.unionByName(met).groupBy("_row").agg(F.count(F.lit(1)).alias("_shared"))


@dataclass(frozen=True)
class PageModel:
    """A linear score on the features (bias first); a page is stuffed where it is above 0."""

    weights: tuple[float, ...]

    def score(self) -> Column:
        out = F.lit(float(self.weights[0]))
        for name, w in zip(FEATURES, self.weights[1:], strict=True):
            out = out + F.lit(float(w)) * F.col(name)
        return out


def fit_pages(rows: np.ndarray, labels: np.ndarray, ridge: float = 0.02, steps: int = 30) -> PageModel | None:
    """Logistic regression by Newton steps on standardised features; None if a class is missing."""
    if len(labels) == 0 or labels.min() == labels.max():
        return None
    mean, spread = rows.mean(0), rows.std(0)
    spread[spread == 0] = 1.0
    x = np.c_[np.ones(len(rows)), (rows - mean) / spread]
    w, keep = np.zeros(x.shape[1]), np.r_[0.0, np.full(x.shape[1] - 1, ridge * len(rows) / 100)]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep + 1e-9)
        step = np.linalg.solve(h, x.T @ (labels - p) - keep * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    raw = w[1:] / spread
    return PageModel((float(w[0] - (raw * mean).sum()), *map(float, raw)))


def stuffed_pages(docs: DataFrame, doc_id: str, labels: DataFrame, text: str = "text", host: str = "source", label: str = "is_spam", sample: int = 50_000) -> DataFrame:
    """``doc_id``, the features and ``score`` of each document; above 0 the page is stuffed.

    The score is fitted on at most ``sample`` labelled rows (those of least id digest); features and phrase
    counts cover all documents and whole texts. Null and empty texts score as empty pages. Repeated rows
    and null ids keep a row each. Without labels of both kinds there is nothing to learn from: a warning is
    given and every score is null.
    """
    pages = page_features(busy(docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text"), F.col(host).alias("_source"))), "_text").drop("_text")
    pages = cut(pages.withColumn("_row", F.monotonically_increasing_id()))
    known = pages.join(shuffled(phrases_elsewhere(pages, "_source")), "_row", "left")
    share = F.coalesce(F.try_divide(F.coalesce("_shared", F.lit(0)).cast("double"), F.size("_phrases")), F.lit(0.0))
    known = cut(known.select("_doc", *FEATURES[:-1], share.alias("elsewhere_share")))
    judged = labels.select(F.col(doc_id).alias("_doc"), F.col(label).alias("_y")).filter("_y is not null")
    judged = cut(judged.orderBy(F.xxhash64("_doc"), "_doc", "_y").limit(sample))
    train = known.join(small_side(judged, sample), "_doc").select("_y", *FEATURES).toPandas()
    model = fit_pages(train[list(FEATURES)].to_numpy(float), train["_y"].to_numpy(float))
    if model is None:
        warnings.warn("labels of both kinds are needed; no page is scored", stacklevel=2)
    score = F.lit(None).cast("double") if model is None else model.score()
    return known.select(F.col("_doc").alias(doc_id), *FEATURES, score.alias("score"))

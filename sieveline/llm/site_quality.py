"""Document quality by hierarchical empirical Bayes: a classifier's evidence and the record of site and section.

A logistic classifier on surface features of the whole text (shares of letters, capitals, digits, signs and
blanks, word length, repeated neighbours, distinct words and lines) gives each document a log odds. Over all
documents the probabilities are then summed by site and by section of a site (host and path, or whatever the caller names). A
site's rate is its sum shrunk to the global rate, a section's rate its sum shrunk to its site's:

    rate = (sum + strength * parent's rate) / (count + strength)

``strength`` comes from the data, by the moments of the groups' rates: groups that differ little are shrunk a lot.
A document's score adds to its own log odds what its section's log odds exceed the global ones by, times ``weight``.

Row rules: null and empty texts have the features of an empty text. A null site or section is a group of its
own. Labels other than 0 and 1, and null texts, teach nothing; without rows of both labels the classifier gives the rate
of label 1. Repeated rows count as often as they occur. Columns that ``keep`` does not name are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sieveline.llm.common import byte_offsets, in_chunks, refuse, stored
from sieveline.llm.shingles import distinct_by_text, word_hashes

FEATURES = 13
_KIND = np.full(256, 4, dtype=np.uint8)  # other signs
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[97:123] = 1
_KIND[128:] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[33, 44, 46, 58, 59, 63, 39, 45]] = 5  # marks of running text


def features(texts: pa.Array) -> np.ndarray:
    """One row of numbers per text."""
    data, offsets = byte_offsets(texts)
    n = len(texts)
    sizes = np.diff(offsets).astype(float)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    kinds = np.bincount(owner * 6 + _KIND[data], minlength=6 * n).reshape(n, 6) / np.maximum(sizes, 1)[:, None]
    loud = np.bincount(owner[data == 33], minlength=n) / np.maximum(sizes, 1)
    words, first = word_hashes(texts)
    count = np.diff(first).astype(float)
    _, at = distinct_by_text(words, first)
    distinct = np.diff(at) / np.maximum(count, 1)
    of = np.repeat(np.arange(n), np.diff(first))
    same = (words[1:] == words[:-1]) & (of[1:] == of[:-1]) if len(words) else np.zeros(0, bool)
    repeated = np.bincount(of[1:][same], minlength=n) / np.maximum(count, 1)
    breaks = np.bincount(owner[data == 10], minlength=n) / np.maximum(count, 1)
    length = np.minimum(sizes / np.maximum(count, 1), 40) / 10
    # Distinct words fall with length by themselves; beside the length the classifier can tell.
    return np.column_stack([kinds[:, 1:], loud * 10, distinct, repeated, breaks, length, np.log1p(sizes) / 10, np.log1p(count) / 10, distinct * np.log1p(count) / 10])


@dataclass
class Model:
    weights: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    bias: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.centre) / self.spread) @ self.weights + self.bias, -12, 12)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id", per_class: int = 5000) -> Model:
    """The classifier, from at most ``per_class`` labels of each kind (those with the smallest hash of ``key``)."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("y")).where("key is not null and y in (0, 1)").distinct()
    known = known.withColumn("h", F.xxhash64("key"))
    chosen = [known.where(f"y = {y}").orderBy("h", "key").limit(per_class).select("key", "y") for y in (1, 0)]
    chosen = stored(chosen[0].union(chosen[1]), "quality-labels")
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("text is not null")
    rows = rows.join(F.broadcast(chosen), "key").select("text", "y")  # 2 * per_class keys at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_chunks(batch, "text"):
                x = features(part.column(0))
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), part.column(1)], names=["x", "y"])

    found = rows.mapInArrow(run, "x array<double>, y int").toArrow()
    y = np.asarray(found.column("y"), dtype=float)
    x = np.asarray(found.column("x").combine_chunks().flatten(), dtype=float).reshape(len(y), FEATURES)
    rate = (y.sum() + 1) / (len(y) + 2)
    model = Model(np.zeros(FEATURES), np.zeros(FEATURES), np.ones(FEATURES), float(np.log(rate / (1 - rate))))
    if not 0 < y.sum() < len(y):
        return model
    model.centre, model.spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.column_stack([(x - model.centre) / model.spread, np.ones(len(y))])
    ridge = np.diag([1.0] * FEATURES + [1e-6])
    w = np.zeros(FEATURES + 1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + ridge, z.T @ (y - p) - ridge @ w)
        w = w + step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    model.weights, model.bias = w[:-1], float(w[-1])
    return model


def evidence(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and the classifier's log odds of each text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_chunks(batch, "_text", 1 << 20):
                odds = shared.value.log_odds(features(part.column(part.num_columns - 1)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(odds)], names=[*keep, "evidence"])

    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return df.select(*keep, F.col(text).cast("string").alias("_text")).mapInArrow(run, f"{kinds}, evidence double")


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def strength(groups: DataFrame, parent: str) -> float:
    """How many documents the parent's rate is worth, by moments over ``groups`` (n, total, <parent>).

    The groups' rates vary by chance, p (1 - p) / n, and by what the groups differ in; the less the latter, the
    larger the strength. Between 1 and 1,000,000.
    """
    rate = F.col("total") / F.col("n")
    chance = F.col(parent) * (1 - F.col(parent))
    row = groups.where("n > 1").agg(
        F.count("*").alias("k"), F.avg((rate - F.col(parent)) ** 2 - chance / F.col("n")).alias("between"), F.avg(chance).alias("chance")
    ).first()
    if not row.k or row.chance is None:
        return 1.0
    return float(min(max(row.chance / max(row.between, 1e-12) - 1, 1.0), 1e6))


def posteriors(scored: DataFrame, site: str, section: str) -> DataFrame:
    """(<site>, <section>, n, site_rate, section_rate, prior): one row per section."""
    p = 1 / (1 + F.exp(-F.col("evidence")))
    sections = stored(scored.groupBy(F.col(site).alias("_site"), F.col(section).alias("_section")).agg(F.count("*").alias("n"), F.sum(p).alias("total")), "quality-sections")
    overall = sections.agg(F.sum("total"), F.sum("n")).first()
    prior = F.lit(float((overall[0] + 1) / (overall[1] + 2)) if overall[1] else 0.5)
    sites = sections.groupBy("_site").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).withColumn("prior", prior)
    to_global = strength(sites, "prior")
    sites = sites.select(F.col("_site").alias("_s"), "prior", ((F.col("total") + to_global * F.col("prior")) / (F.col("n") + to_global)).alias("site_rate"))
    joined = stored(sections.join(sites, F.col("_site").eqNullSafe(F.col("_s"))).drop("_s"), "quality-sites")
    to_site = strength(joined, "site_rate")
    return joined.withColumn("section_rate", (F.col("total") + to_site * F.col("site_rate")) / (F.col("n") + to_site)).drop("total")


def predict(
    df: DataFrame,
    model: Model,
    site: str = "source",
    section: str = "lang",
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    weight: float = 0.5,
    threshold: float = 0.5,
) -> DataFrame:
    """Per row: the ``keep`` columns, evidence, site_rate, section_rate, score (0 to 1), predicted (1: good).

    A column to be kept that is named like one of these, or n, prior, _site or _section, raises.
    """
    named = tuple(dict.fromkeys((*keep, site, section)))
    refuse(named, ("evidence", "_site", "_section", "n", "prior", "site_rate", "section_rate", "score", "predicted"))
    scored = stored(evidence(df, model, text, named), "quality-evidence")
    rates = posteriors(scored, site, section)
    if rates.limit(500_001).count() <= 500_000:
        rates = F.broadcast(rates)
    both = scored.join(rates, F.col(site).eqNullSafe(F.col("_site")) & F.col(section).eqNullSafe(F.col("_section")))
    odds = F.col("evidence") + weight * (_logit(F.col("section_rate")) - _logit(F.col("prior")))
    score = 1 / (1 + F.exp(-odds))
    return both.select(*keep, "evidence", "site_rate", "section_rate", score.alias("score"), F.when(score >= threshold, 1).otherwise(0).alias("predicted"))

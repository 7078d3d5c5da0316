"""The registered queries of this subpackage, each a thin digest of its operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sieveline.llm import adaptive_scan, decontaminate, jaccard_join, language_mixture, personal_data, sentence_pieces, site_quality, source_divergence, suffix_dedup, token_counts, token_files, toxicity, whitening
from sieveline.llm.common import ship, table
from sieveline.session import scratch_dir

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")
BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


def _held_out(divisor: int, rest: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % divisor == rest, F.lit(False))


@query
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = jaccard_join.join(table(spark, sf_dir, "documents"), similarity=0.9, width=3)
    return members.select("doc_id", "n_shingles", "component_id")


ORACLES["op1_jaccard_join"] = jaccard_join.oracle(0.9, 3)


@query
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digest(personal_data.extract(table(spark, sf_dir, "documents")))


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, WORD_MODEL, end_id=1)
    return token_files.read_digest(spark, path)


@query
def op4_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the labels of rows that are not held out; ``source`` is the site, ``lang`` its section."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", _held_out(5, 2))
    model = site_quality.fit(docs, table(spark, sf_dir, "labels").where(~_held_out(5, 2)))
    return site_quality.predict(docs, model, keep=("doc_id", "held_out"))


@query
def op5_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", _held_out(4, 2))
    model = language_mixture.fit(docs.where("not held_out"))
    return language_mixture.predict(docs, model, keep=("doc_id", "held_out"))


@query
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.encode_digest(table(spark, sf_dir, "documents"), PIECE_MODEL)


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Learned from the labelled rows that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~_held_out(3, 1))
    return toxicity.fit(table(spark, sf_dir, "documents"), labels)


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", _held_out(3, 1))
    return toxicity.predict(docs, toxicity_model(spark, sf_dir), keep=("doc_id", "held_out"))


@query
def op8_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adaptive_scan.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"), with_kept=False).drop("spans")


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op10_decontaminate"] = decontaminate.oracle()


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)


@query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``spark.sieveline.tokenCounts`` names a lasting cache; without it the query starts one of its own."""
    cache = spark.conf.get("spark.sieveline.tokenCounts", None) or scratch_dir(spark, "token-counts")
    return token_counts.count(table(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_MODEL, cache)


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op13_source_divergence"] = source_divergence.oracle()


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it takes its models from this module

    return corpus_pipeline.run(spark, sf_dir)

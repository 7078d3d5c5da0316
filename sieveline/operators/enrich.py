"""News enrichment and quarantine explanations around a caller-supplied model."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sieveline import config as C
from sieveline.functions import text as X

RESPONSE_SCHEMA = (
    "sentiment string, confidence string, tickers_mentioned array<string>, topic_tags array<string>, "
    "market_implication string"
)


def pending_articles(news: DataFrame, enriched: DataFrame, limit: int | None = None) -> DataFrame:
    """Verified articles without enrichment, oldest first."""
    rows = news.join(enriched.select("article_id"), "article_id", "left_anti").orderBy("ingested_at", "article_id")
    return rows if limit is None else rows.limit(limit)


def article_prompts(
    news: DataFrame,
    symbols: Iterable[str] = tuple(C.SYMBOL_NAMES),
    template: str = X.ARTICLE_TEMPLATE,
    cut: int = C.DESCRIPTION_CUT,
) -> DataFrame:
    """One request text per article; of its description the first ``cut`` characters."""
    prompt = X.render(
        template,
        title=X.or_default(F.col("title"), "No title"),
        description=F.substring(X.or_default(F.col("description"), "No description"), 1, cut),
        source=X.or_default(F.col("source_name"), "Unknown"),
        symbols=F.lit(", ".join(symbols)),
    )
    return news.select("article_id", prompt.alias("prompt"))


def score(
    requests: DataFrame, model: Callable[[str], str], key: str = "article_id", partitions: int | None = None
) -> DataFrame:
    """Call ``model`` on every prompt: key, response, error.

    The model is the caller's Python callable, so this is the one operator that leaves
    the JVM, in Arrow batches. A failing call fills ``error`` and the rest go on. Calls
    run one after another within a partition; ``partitions`` sets how many run at once.
    """
    if partitions is not None:
        requests = requests.repartition(partitions)

    def answer(prompt: str) -> tuple[str | None, str | None]:
        try:
            return model(prompt), None
        except Exception as problem:  # the caller's code; one bad row must not end the task
            return None, f"{type(problem).__name__}: {problem}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [answer(p) for p in batch["prompt"]]
            yield pd.DataFrame(
                {
                    key: batch[key],
                    "response": pd.Series([a for a, _ in answers], dtype=object),
                    "error": pd.Series([e for _, e in answers], dtype=object),
                }
            )

    kind = requests.schema[key].dataType.simpleString()
    return requests.select(key, "prompt").mapInPandas(run, f"{key} {kind}, response string, error string")


def clamp(x: Column) -> Column:
    """Number limited to 0..1; null where it is none."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x.try_cast("double")))


def parse_responses(scored: DataFrame, raw: str = "response", key: str = "article_id") -> DataFrame:
    """Validated fields per response, or the ``reject_reason``.

    Reasons in order: no_response, invalid_json, missing_fields, invalid_sentiment,
    invalid_confidence.
    """
    # One generated row per response: parsed once, whatever later filters ask of its fields.
    parts = F.struct(
        F.json_object_keys("_body").alias("_keys"), F.from_json("_body", RESPONSE_SCHEMA).alias("_fields")
    )
    parsed = scored.withColumn("_body", X.strip_fences(F.col(raw))).select(
        key, F.col(raw).isNull().alias("_silent"), F.inline(F.array(parts))
    )
    absent = F.array_except(F.array(*[F.lit(f) for f in C.RESPONSE_FIELDS]), F.col("_keys"))
    reason = (
        F.when(F.col("_silent"), "no_response")
        .when(F.col("_keys").isNull() | F.col("_fields").isNull(), "invalid_json")
        .when(F.size(absent) > 0, "missing_fields")
        .when(~F.coalesce(F.col("_fields.sentiment").isin(*C.SENTIMENTS), F.lit(False)), "invalid_sentiment")
        .when(F.col("_fields.confidence").try_cast("double").isNull(), "invalid_confidence")
    )
    fields = {name: F.col(f"_fields.{name}") for name in C.RESPONSE_FIELDS}
    fields["confidence"] = clamp(fields["confidence"])
    judged = parsed.select(key, "_fields", F.explode(F.array(reason)).alias("reject_reason"))
    valid = F.col("reject_reason").isNull()
    return judged.select(
        key, *[F.when(valid, column).alias(name) for name, column in fields.items()], "reject_reason"
    )


def enriched_rows(parsed: DataFrame, enriched_at: Column) -> DataFrame:
    """Accepted responses in the shape of ``enriched_news``."""
    return (
        parsed.filter(F.col("reject_reason").isNull())
        .drop("reject_reason")
        .withColumn("enriched_at", enriched_at.cast("timestamp"))
    )


def response_rejects(parsed: DataFrame) -> DataFrame:
    """Rejected responses by reason; they are not stored, so the next run asks again."""
    return (
        parsed.filter(F.col("reject_reason").isNotNull())
        .groupBy("reject_reason")
        .agg(F.count("*").alias("n_rejected"))
    )


def pending_explanations(quarantine: DataFrame, limit: int | None = None) -> DataFrame:
    """Quarantined records without an explanation, oldest first; ``limit`` sets how many a run takes."""
    rows = quarantine.filter(F.col("explanation").isNull()).orderBy("quarantined_at", "record_id")
    return rows if limit is None else rows.limit(limit)


def explanation_prompts(
    quarantine: DataFrame, template: str = X.QUARANTINE_TEMPLATE, cut: int = C.RAW_RECORD_CUT
) -> DataFrame:
    """One request text per quarantined record; of the record the first ``cut`` characters."""
    prompt = X.render(
        template,
        source=F.col("source"),
        code=F.col("failure_code"),
        detail=X.or_default(F.col("failure_detail"), "no additional detail provided"),
        record=X.or_default(F.substring("raw_record", 1, cut), "{}"),
    )
    return quarantine.select("record_id", prompt.alias("prompt"))


def write_back(quarantine: DataFrame, answers: DataFrame) -> DataFrame:
    """The log with new explanations filled in by record_id, outer quotes removed.

    ``answers`` has record_id and response; rows without an answer keep what they had. Of several
    answers to one record the last in text order counts, so the log keeps its rows.
    """
    new = answers.groupBy("record_id").agg(F.max("response").alias("response"))
    new = new.select("record_id", X.strip_quotes(F.col("response")).alias("_new"))
    return (
        quarantine.join(new, "record_id", "left")
        .withColumn("explanation", F.coalesce("_new", "explanation"))
        .select(*quarantine.columns)
    )

"""Prompts, responses, explanations."""

import pytest
from pyspark.sql import functions as F

from sieveline.functions import text as X
from sieveline.operators import enrich as E

GOOD = '{"sentiment":"bullish","confidence":%s,"tickers_mentioned":["A"],"topic_tags":["x","y"],"market_implication":"m"}'


@pytest.mark.parametrize(
    "raw, reason, confidence",
    [
        (GOOD % "0.5", None, 0.5),
        ("```json\n" + GOOD % "0.5" + "\n```", None, 0.5),
        ("```" + GOOD % "0.5" + "```", None, 0.5),
        ("  " + GOOD % "0.5" + "\n", None, 0.5),
        (GOOD % "1.7", None, 1.0),
        (GOOD % "-2", None, 0.0),
        (GOOD % '"0.25"', None, 0.25),
        (GOOD % '"high"', "invalid_confidence", None),
        (GOOD.replace("bullish", "mixed") % "0.5", "invalid_sentiment", None),
        ('{"sentiment":"bullish"}', "missing_fields", None),
        ("I cannot help", "invalid_json", None),
        ('["a"]', "invalid_json", None),
        (None, "no_response", None),
    ],
)
def test_parse(rows, raw, reason, confidence):
    row = E.parse_responses(rows([("a", raw)], "article_id string, response string")).first()
    assert (row.reject_reason, row.confidence) == (reason, confidence)
    if reason is None:
        assert (row.sentiment, row.tickers_mentioned, row.topic_tags) == ("bullish", ["A"], ["x", "y"])
    else:
        assert row.sentiment is None


def test_rejects_are_counted_and_asked_again(rows):
    scored = rows([("a", GOOD % "0.5"), ("b", "no"), ("c", "no"), ("d", None)], "article_id string, response string")
    parsed = E.parse_responses(scored)
    assert {tuple(r) for r in E.response_rejects(parsed).collect()} == {("invalid_json", 2), ("no_response", 1)}
    enriched = E.enriched_rows(parsed, F.current_timestamp())
    news = scored.select("article_id", F.lit(1).alias("ingested_at"))
    assert [r.article_id for r in E.pending_articles(news, enriched).collect()] == ["b", "c", "d"]
    assert [r.article_id for r in E.pending_articles(news, enriched, 2).collect()] == ["b", "c"]


def test_failing_calls_stay_rows(rows):
    def model(prompt):
        if "bad" in prompt:
            raise ValueError("refused")
        return prompt.upper()

    requests = rows([("1", "good"), ("2", "bad one")], "article_id string, prompt string")
    got = {r.article_id: (r.response, r.error) for r in E.score(requests, model).collect()}
    assert got == {"1": ("GOOD", None), "2": (None, "ValueError: refused")}


def test_article_prompt(rows):
    schema = "article_id string, title string, description string, source_name string"
    prompts = E.article_prompts(rows([("1", "", "d" * 700, None)], schema), ["A", "B"]).first().prompt
    assert "Title: No title\n" in prompts and "Source: Unknown\n" in prompts and "Symbols followed: A, B\n" in prompts
    assert "d" * 600 in prompts and "d" * 601 not in prompts


def test_explanations(rows):
    schema = "record_id string, source string, quarantined_at int, failure_code string, failure_detail string, explanation string, raw_record string"
    log = rows(
        [("1", "s", 2, "STALE", None, None, "r" * 900), ("2", "s", 1, "STALE", "late", None, None), ("3", "s", 0, "STALE", "x", "done", "{}")],
        schema,
    )
    assert [r.record_id for r in E.pending_explanations(log).collect()] == ["2", "1"]
    prompts = {r.record_id: r.prompt for r in E.explanation_prompts(log).collect()}
    assert "Detail: no additional detail provided\n" in prompts["1"] and "r" * 800 in prompts["1"]
    assert "r" * 801 not in prompts["1"] and "Record: {}\n" in prompts["2"]
    answers = rows([("1", "\"It is late.\""), ("9", "unknown")], "record_id string, response string")
    back = {r.record_id: r.explanation for r in E.write_back(log, answers).collect()}
    assert back == {"1": "It is late.", "2": None, "3": "done"}


def test_fences_only_at_the_start(rows):
    got = rows([("{} ``` x",), ("```json {} ```",), ("```\n{}\n``` tail",)], "raw string").select(
        X.strip_fences(F.col("raw")).alias("body")
    )
    assert [r.body for r in got.collect()] == ["{} ``` x", "{}", "{}"]

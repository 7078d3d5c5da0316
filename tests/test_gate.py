"""The gate: codes, order, limits, duplicates, routes."""

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from sieveline import config as C, schemas
from sieveline.operators import gate as G
from sieveline.plans import runs
from sieveline.session import scratch_dir

NOW = datetime(2026, 6, 30, 12, 0, tzinfo=timezone.utc)
BAR = "ticker string, date string, open double, high double, low double, close double, volume bigint"
TEXT_BAR = "ticker string, date string, open string, high string, low string, close string, volume string"
STOCKS, NEWS, REDDIT = C.RULES["stocks"], C.RULES["news"], C.RULES["reddit"]


def bar(**changes):
    base = dict(ticker="A.NS", date="2026-06-30", open=100.0, high=105.0, low=98.0, close=102.0, volume=10000)
    base.update(changes)
    return tuple(base[k] for k in ("ticker", "date", "open", "high", "low", "close", "volume"))


def codes(df):
    return [r.failure_code for r in df.collect()]


@pytest.mark.parametrize(
    "changes, code",
    [
        (dict(close=None), C.SCHEMA_MISSING_FIELD),
        (dict(close=-50.0), C.RANGE_VIOLATION),
        (dict(high=90.0, close=95.0), C.RANGE_VIOLATION),
        (dict(volume=-500), C.RANGE_VIOLATION),
        (dict(), None),
        (dict(open=0.0), C.RANGE_VIOLATION),
        (dict(close=float("nan")), C.RANGE_VIOLATION),
        (dict(volume=0), None),
        (dict(high=98.0), None),
        (dict(close=200.0), None),  # close outside low..high is not checked
        (dict(date="not-a-date"), C.STALE),
        (dict(date="2026-13-01"), C.STALE),
        (dict(date="2026-6-30"), None),
        (dict(date="2026"), C.STALE),
        (dict(date="2026-06-27"), C.STALE),  # 3 days and 12 hours old
        (dict(date="2026-06-28"), None),
        (dict(date="2026-07-01"), C.STALE),  # 12 hours ahead
        (dict(close=-1.0, date="2020-01-01"), C.RANGE_VIOLATION),  # first failure wins
        (dict(ticker=None, close=-1.0), C.SCHEMA_MISSING_FIELD),
    ],
)
def test_bar_rules(rows, changes, code):
    assert codes(G.gate(rows([bar(**changes)], BAR), STOCKS, NOW)) == [code]


def test_age_limit_itself_passes(rows):
    df = rows([bar(date="2026-06-27")], BAR)
    exact = datetime(2026, 6, 30, tzinfo=timezone.utc)
    assert codes(G.gate(df, STOCKS, exact)) == [None]
    assert codes(G.gate(df, STOCKS, exact + timedelta(seconds=1))) == [C.STALE]


def test_future_limit_itself_passes(rows):
    df = rows([bar(date="2026-07-01")], BAR)
    midnight = datetime(2026, 7, 1, tzinfo=timezone.utc)
    assert codes(G.gate(df, STOCKS, midnight - timedelta(minutes=5))) == [None]
    assert codes(G.gate(df, STOCKS, midnight - timedelta(minutes=5, seconds=1))) == [C.STALE]


def test_wrong_type_is_not_missing(rows):
    data = [
        ("A", "2026-06-30", "100", "105", "98", "102", "10"),
        ("A", "2026-06-30", "100", "105", "98", "abc", "10"),
        ("A", "2026-06-30", "100", "105", "98", "NaN", "10"),
        ("A", "2026-06-30", "100", "105", "98", "102", "many"),
    ]
    gated = G.gate(rows(data, TEXT_BAR), STOCKS, NOW).collect()
    assert [r.failure_code for r in gated] == [None, C.SCHEMA_WRONG_TYPE, C.RANGE_VIOLATION, C.SCHEMA_WRONG_TYPE]
    assert gated[1].failure_detail == "not a number: close=abc"
    assert gated[3].failure_detail == "not a number: volume=many"


def test_absent_columns_are_missing_fields(rows):
    df = rows([("u", "t")], "url string, title string")
    row = G.gate(df, NEWS, NOW).first()
    assert row.failure_code == C.SCHEMA_MISSING_FIELD
    assert row.failure_detail == "missing fields: article_id, published_at"


NEWS_ROW = "article_id string, title string, url string, published_at string"


@pytest.mark.parametrize(
    "title, at, code",
    [
        ("Rates held", "2026-06-30T11:00:00Z", None),
        ("Rates held", "2026-06-30T11:00:00", None),
        ("Rates held", "2026-06-30T16:30:00+05:30", None),
        ("Rates held", "2026-06-28T12:00:00Z", None),
        ("Rates held", "2026-06-28T11:59:59Z", C.STALE),
        ("Rates held", "2026", C.STALE),
        ("Rates held", "yesterday", C.STALE),
        ("", "2026-06-30T11:00:00Z", C.RANGE_VIOLATION),
        (" \t　 ", "2026-06-30T11:00:00Z", C.RANGE_VIOLATION),
        (None, "2026-06-30T11:00:00Z", C.SCHEMA_MISSING_FIELD),
    ],
)
def test_news_rules(rows, title, at, code):
    assert codes(G.gate(rows([("a", title, "u", at)], NEWS_ROW), NEWS, NOW)) == [code]


def test_score_must_be_numeric(rows):
    schema = "post_id string, subreddit string, title string, score string, created_utc string"
    at = "2026-06-30T11:00:00+00:00"
    data = [("1", "s", "", "12", at), ("2", "s", "t", "many", at), ("3", "s", "t", None, at)]
    assert codes(G.gate(rows(data, schema), REDDIT, NOW)) == [None, C.RANGE_VIOLATION, C.SCHEMA_MISSING_FIELD]


@pytest.mark.parametrize("unique", [True, False])
def test_duplicate_of_verified_record(rows, unique):
    raw = rows([bar(), bar(date="2026-06-29"), bar(date="2026-6-28"), bar(close=None)], BAR)
    stored = [("A.NS", date(2026, 6, 30)), ("A.NS", date(2026, 6, 28)), ("B.NS", date(2026, 6, 29))]
    known = rows(stored if unique else stored * 3, "ticker string, date date")
    gated = G.gate(raw, STOCKS, NOW, known, verified_unique=unique)
    got = {r.date + ("" if r.close else "!"): r.failure_code for r in gated.collect()}
    assert got == {
        "2026-06-30": C.DUPLICATE, "2026-06-29": None, "2026-6-28": C.DUPLICATE,
        "2026-06-30!": C.SCHEMA_MISSING_FIELD,
    }


def test_both_lookups_agree_and_keep_every_record(spark, rows):
    """A third of all records share one key; some fail earlier rules."""
    n = 3000
    raw = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("T"), F.col("id") % 100)).alias("ticker"),
        F.lit("2026-06-30").alias("date"), F.lit(10.0).alias("open"), F.lit(11.0).alias("high"),
        F.lit(9.0).alias("low"), F.when(F.col("id") % 7 == 0, -1.0).otherwise(10.0).alias("close"),
        F.lit(1).cast("bigint").alias("volume"), F.col("id").alias("seq"),
    )
    known = rows([("HOT", date(2026, 6, 30)), ("T1", date(2026, 6, 30))], "ticker string, date date")
    once = G.gate(raw, STOCKS, NOW, known, verified_unique=True).collect()
    anyhow = G.gate(raw, STOCKS, NOW, known.union(known)).collect()
    assert len(once) == len(anyhow) == n
    assert {(r.seq, r.failure_code, r.failure_detail) for r in once} == {
        (r.seq, r.failure_code, r.failure_detail) for r in anyhow
    }
    expected = {
        i: C.RANGE_VIOLATION if i % 7 == 0 else C.DUPLICATE if i % 3 == 0 or i % 100 == 1 else None for i in range(n)
    }
    assert {r.seq: r.failure_code for r in once} == expected


def test_copies_in_one_batch(rows):
    raw = rows([(*bar(), 1), (*bar(close=103.0), 2), (*bar(ticker="B.NS"), 3)], BAR + ", seq bigint")
    assert codes(G.gate(raw, STOCKS, NOW)) == [None, None, None]
    flagged = {r.seq: r.failure_code for r in G.gate(raw, STOCKS, NOW, intra_batch="seq").collect()}
    assert flagged == {1: None, 2: C.DUPLICATE, 3: None}


def test_lookup_reads_only_reachable_days(spark, rows):
    path = scratch_dir(spark, "verified")
    days = [("A.NS", date(2026, 6, 1) + timedelta(days=i)) for i in range(30)]
    rows(days, "ticker string, date date").write.partitionBy("date").parquet(path)
    gated = G.gate(rows([bar()], BAR), STOCKS, NOW, spark.read.parquet(path), verified_unique=True)
    assert codes(gated) == [C.DUPLICATE]
    plan = gated._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2026-06-26" in plan


def test_logs_and_routes(rows):
    raw = rows([(*bar(), 1), (*bar(), 2), (*bar(close=None), 3)], BAR + ", seq bigint")
    fields = ["ticker", "date", "open", "high", "low", "close", "volume"]
    identified = G.identify(G.gate(raw, STOCKS, NOW), STOCKS, fields, "seq")
    log = G.gate_log(identified, STOCKS, NOW).collect()
    assert len({r.record_id for r in log}) == 3 and [r.passed for r in log] == [True, True, False]
    assert G.gate_log(identified, STOCKS, NOW).columns == schemas.TABLES["gate_results"].fieldNames()
    held = G.quarantine_log(identified, STOCKS, NOW)
    assert set(held.columns) == set(schemas.TABLES["quarantine_log"].fieldNames())
    row = held.first()
    assert row.failure_code == C.SCHEMA_MISSING_FIELD and '"close":null' in row.raw_record
    again = G.gate_log(identified, STOCKS, NOW).collect()
    assert [r.record_id for r in again] == [r.record_id for r in log]
    assert G.passed_records(G.gate(raw, STOCKS, NOW), fields).count() == 2
    failed = G.failed_records(G.gate(raw, STOCKS, NOW), fields)
    assert failed.columns[-2:] == ["_failure_code", "_failure_detail"] and failed.count() == 1
    summary = G.summary(G.gate(raw, STOCKS, NOW), "stocks").first()
    assert (summary.total, summary.passed, summary.failed) == (3, 2, 1)


def test_verified_rows_take_the_table_schema(rows):
    passed = rows([bar()], BAR)
    out = G.verified_rows(passed, schemas.TABLES["bronze_stocks"], {"ingested_at": F.lit("2026-06-30 12:00:00")})
    assert out.schema == schemas.TABLES["bronze_stocks"]
    row = out.first()
    assert row.date == date(2026, 6, 30) and row.source_file is None
    texts = rows([("A", "2026-06-30", "1", "2", "1", "1.5", "10.0")], TEXT_BAR)
    row = G.verified_rows(G.gate(texts, STOCKS, NOW).filter("passed"), schemas.TABLES["bronze_stocks"]).first()
    assert (row.close, row.volume) == (1.5, 10)


def test_one_broken_source_does_not_stop_the_rest(spark, rows):
    jobs = {
        "stocks": runs.GateJob(STOCKS, lambda: rows([bar(), bar(close=None)], BAR), NOW),
        "gone": runs.GateJob(NEWS, lambda: spark.read.parquet("/nowhere/at/all"), NOW),
        "news": runs.GateJob(NEWS, lambda: rows([("a", "t", "u", "2026-06-30T11:00:00Z")], NEWS_ROW), NOW),
    }
    got = {r.source: r for r in runs.gate_all_sources(spark, jobs, scratch_dir(spark, "run")).collect()}
    assert (got["stocks"].total, got["stocks"].passed, got["stocks"].failed) == (2, 1, 1)
    assert got["gone"].error.startswith("AnalysisException: [PATH_NOT_FOUND]") and got["gone"].total is None
    assert got["news"].passed == 1


def test_all_rules_name_their_fields():
    for name, rules in C.RULES.items():
        assert rules.time_field in rules.required, name
        assert rules.prices == () or set(rules.prices) <= set(rules.required)
        if name != "ticks":
            assert set(rules.key) <= set(rules.required)
    assert C.RULES["news"].max_age == timedelta(hours=48) and C.RULES["macro"].max_age == timedelta(days=7)

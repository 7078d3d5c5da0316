"""Versions that are written, audited and published; readers see one whole version."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from sieveline.plans import serving as S
from sieveline.plans.served import BrokenBuild, Served
from sieveline.session import scratch_dir
from test_serving import DAY, mart, news


def lines(df):
    return [r.line for r in df.orderBy("brief_date", "section", "position").collect()]


def test_published_versions_replace_each_other(spark, rows):
    served = Served(spark, scratch_dir(spark, "served"))
    assert served.current() is None and served.brief().count() == 0 and served.context(mart(rows).schema).count() == 0
    assert served.publish(1, mart(rows), news(rows)).can_serve
    assert lines(served.brief()) == lines(S.market_brief(mart(rows), news(rows)))
    assert served.context(mart(rows).schema).drop("can_serve", "forced").exceptAll(mart(rows)).count() == 0
    assert served.refusal().first().refusal is None and served.citations().count() == 2
    assert not served.publish(2, mart(rows, blocked=True), news(rows)).can_serve
    assert served.brief().count() == 0 and served.context(mart(rows).schema).count() == 0
    assert "Financial news" in served.refusal().first().refusal
    assert served.brief(force=True).count() == 8 and {r.forced for r in served.context(mart(rows).schema, force=True).collect()} == {True}
    with pytest.raises(ValueError):
        served.publish(2, mart(rows), news(rows))
    served.publish(3, mart(rows), news(rows))
    assert sorted(p.name for p in Path(served.root, "data").glob("version=*")) == ["version=2", "version=3"]


def test_a_build_that_fails_its_tests_is_not_published(spark, rows):
    served = Served(spark, scratch_dir(spark, "served"))
    served.publish(1, mart(rows), news(rows))
    broken = mart(rows).withColumn("close", F.when(F.col("ticker") == "TCS.NS", F.col("close")))
    with pytest.raises(BrokenBuild, match="not_null close: 1"):
        served.publish(2, broken, news(rows))
    assert served.current().version == 1 and served.brief().count() == 8
    failing = mart(rows).withColumn("close", F.raise_error(F.lit("while writing")).cast("double"))
    with pytest.raises(Exception, match="while writing"):
        served.publish(2, failing, news(rows))
    assert served.current().version == 1
    assert served.publish(2, mart(rows), news(rows)).version == 2  # the same number, mended


def test_readers_scan_stored_tables_only(spark, rows):
    served = Served(spark, scratch_dir(spark, "served"))
    served.publish(1, mart(rows), news(rows))
    for df in (served.brief(), served.context(mart(rows).schema), served.status()):
        plan = plan_of(df)
        assert plan.count("FileScan") == 1 and "Exchange hashpartitioning" not in plan and "Join" not in plan
    day = plan_of(served.brief().where(F.col("brief_date") == F.lit(DAY)))
    assert "PartitionFilters: [isnotnull(brief_date" in day


def test_a_day_without_news_says_so(rows):
    quiet = lines(S.market_brief(mart(rows), news(rows).where("false")))
    assert quiet[-2:] == ["SENTIMENT: BULLISH (0 articles)", S.NO_NEWS]
    one = lines(S.market_brief(mart(rows), news(rows).where("article_id = '1'")))
    assert "SENTIMENT: BULLISH (1 article)" in one and S.NO_NEWS not in one

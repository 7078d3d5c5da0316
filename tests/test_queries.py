"""Every registered query next to its SQL, and the shape of the plans."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import TABLES, rows_of
from conftest import plan_of
from workload import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def con():
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = queries()[name](spark, SF)
    got, columns = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(oracle_sql()[name])
    want, want_columns = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert columns == want_columns
    assert got == want


def test_entry(spark):
    assert entry(spark).count() > 0


CHECKED = (
    "gate_decision gate_duplicate moving_averages symbol_mart price_anomalies trust_scores daily_sentiment tick_gate "
    "extract_links parse_responses market_brief headline_context"
).split()


@pytest.mark.parametrize("name", CHECKED)
def test_plans_hold_no_cross_join_and_no_python(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert unwanted not in plan


@pytest.mark.parametrize("name", ["latest_per_key", "dedupe_first", "symbol_headlines", "moving_averages", "tick_events"])
def test_per_key_limits_run_before_the_shuffle(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert any(line.rstrip().endswith("Partial") for line in limits)


def test_row_rules_need_no_shuffle(spark):
    assert "Exchange" not in plan_of(queries()["tick_gate"](spark, SF))
    assert "Exchange" not in plan_of(queries()["stream_decode"](spark, SF))


def test_large_windows_are_cut_by_bucket(spark):
    """No window over bars is partitioned by symbol alone, except over one row per bucket."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(queries()["moving_averages"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_symbol = [line for line in plan.splitlines() if "Window [" in line and "_bucket#" not in line.split("windowspecdefinition(")[1].split(", specified")[0]]
    assert by_symbol == []

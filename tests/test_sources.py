"""Snapshots, named tables, keyed logs, run log, layers."""

import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from sieveline import schemas
from sieveline.plans import runs
from sieveline.session import scratch_dir
from sieveline.sources import snapshots as N, tables as T

SMALL = "ticker string, close double, _corrupt_record string"


def small():
    return schemas._schema(SMALL)


def test_snapshot_replaces_only_its_day(spark, rows):
    zone = scratch_dir(spark, "zone")
    data = rows([("A", 1.0, date(2024, 1, 1)), ("B", None, date(2024, 1, 2))], "ticker string, close double, d date")
    N.write_snapshot(data.select("ticker", "close", "d"), zone, "bars", day_column="d")
    N.write_snapshot(data.limit(1).select("ticker", F.lit(9.0).alias("close")), zone, "bars", day="2024-01-01")
    got = {(str(r.day), r.ticker, r.close, r.feed) for r in N.read_snapshot(spark, zone, small()).collect()}
    assert got == {("2024-01-01", "A", 9.0, "bars"), ("2024-01-02", "B", None, "bars")}
    one = N.read_snapshot(spark, zone, small(), "bars", "2024-01-02")
    assert [r.ticker for r in one.collect()] == ["B"]
    assert "PartitionFilters: [" in one._jdf.queryExecution().executedPlan().toString()
    lineage = N.file_lineage(spark, zone, small(), "*.json").groupBy("directory").agg(F.sum("n_records").alias("n"))
    assert {r.directory: r.n for r in lineage.collect()} == {"feed=bars/day=2024-01-01": 1, "feed=bars/day=2024-01-02": 1}


def test_json_array_file(spark, tmp_path):
    path = os.path.join(tmp_path, "day.json")
    with open(path, "w") as out:
        json.dump([{"ticker": "A", "close": 1.5}, {"ticker": "B", "close": None}], out, indent=2)
    got = [(r.ticker, r.close) for r in N.read_json_array(spark, path, small()).collect()]
    assert got == [("A", 1.5), ("B", None)]


def test_broken_line_keeps_its_text(spark, tmp_path):
    with open(os.path.join(tmp_path, "x.json"), "w") as out:
        out.write('{"ticker":"A","close":1.0}\n{"ticker":"B","clo\n')
    got = spark.read.schema(small()).json(str(tmp_path)).collect()
    assert [r._corrupt_record for r in got] == [None, '{"ticker":"B","clo']


def test_keyed_log_and_compaction(spark, rows):
    root = scratch_dir(spark, "log")
    make = lambda data: rows(data, "k string, v int, seq int")
    T.append(make([("a", 1, 1), ("b", 1, 1)]), f"{root}/log")
    T.append(make([("a", 2, 2)]), f"{root}/log")
    want = {("a", 2, 2), ("b", 1, 1)}
    assert {tuple(r) for r in T.current(spark, f"{root}/log", ["k"], ["seq"]).collect()} == want
    T.compact(spark, f"{root}/log", f"{root}/new", ["k"], ["seq"])
    assert {tuple(r) for r in spark.read.parquet(f"{root}/new").collect()} == want
    with pytest.raises(ValueError):
        T.compact(spark, f"{root}/log", f"{root}/log/", ["k"], ["seq"])


def test_named_sources(spark, rows):
    where = scratch_dir(spark, "src")
    rows([(1,)], "x int").write.parquet(where)
    sources = T.Sources(spark, {"here": where, "gate_results": where + "-none", "strange": where + "-none"})
    assert sources.names() == ["gate_results", "here", "strange"]
    assert sources.scan("here").count() == 1
    empty = sources.scan("gate_results")
    assert empty.count() == 0 and empty.schema == schemas.TABLES["gate_results"]
    with pytest.raises(Exception):
        sources.scan("strange")
    with pytest.raises(KeyError):
        sources.scan("undeclared")


def test_run_log(spark, rows):
    root = scratch_dir(spark, "runs")

    def log(name, load):
        return T.logged_run(spark, "r", name, load, lambda df: df.write.parquet(f"{root}/{name}"), "none found")

    done = log("done", lambda: rows([(1,), (2,)], "x int"))
    assert done.columns == schemas.TABLES["pipeline_runs"].fieldNames()
    row = done.first()
    assert (row.records, row.status, row.error) == (2, "success", None)
    assert spark.read.parquet(f"{root}/done").count() == 2
    row = log("none", lambda: rows([], "x int")).first()
    assert (row.records, row.status, row.error) == (0, "success", "none found")
    row = log("gone", lambda: spark.read.parquet("/nowhere/at/all")).first()
    assert (row.records, row.status) == (0, "failed") and row.error.startswith("AnalysisException")
    row = log("late", lambda: rows([(0,)], "x int").select(F.lit(1) / F.col("x"))).first()
    assert row.status == "failed"


def test_every_table_has_schema_and_key(spark):
    for name, key in schemas.KEYS.items():
        assert set(key) <= set(schemas.TABLES[name].fieldNames())
        assert schemas.empty(spark, name).count() == 0


def test_layers(spark, rows):
    df = rows([(1,), (2,)], "x int")
    models = {
        "stg_t": runs.Model("silver", "view", lambda ref: df),
        "int_t": runs.Model("silver", "table", lambda ref: ref("stg_t").withColumn("y", F.col("x") + 1)),
        "mart_t": runs.Model("gold", "table", lambda ref: ref("int_t").filter("y = 3")),
    }
    root = scratch_dir(spark, "layers")
    inventory = runs.materialize(spark, models, root)
    got = {(r.table_schema, r.table_name): (r.table_type, r.n_rows) for r in inventory.collect()}
    assert got[("silver", "int_t")] == ("BASE TABLE", 2) and got[("gold", "mart_t")] == ("BASE TABLE", 1)
    assert got[("", "silver_stg_t")] == ("VIEW", 2)
    assert spark.table("gold.mart_t").first().x == 2
    # A second build replaces the tables in their new place.
    runs.materialize(spark, models, scratch_dir(spark, "layers"))
    assert spark.table("silver.int_t").count() == 2


def test_channels_fail_alone(spark, rows):
    from pyspark.sql import functions as F

    from sieveline.sources import tables

    path = scratch_dir(spark, "channels")
    good, other = rows([(1, "x")], "a int, b string"), rows([(2,), (3,)], "a int")
    channels = {"good": lambda: good, "other": lambda: other, "late": lambda: other.withColumn("a", F.raise_error(F.lit("gone")).cast("int")), "none": lambda: spark.read.parquet("/nowhere")}
    log = {r.source: (r.status, r.records) for r in tables.store_channels(spark, channels, path, "7", at_once=2).collect()}
    assert log == {"good": ("success", 1), "other": ("success", 2), "late": ("failed", 0), "none": ("failed", 0)}
    got = tables.stored_channels(spark, path, "7")
    assert sorted((r.channel, r.a, r.b) for r in got.collect()) == [("good", 1, "x"), ("other", 2, None), ("other", 3, None)]


def test_json_arrays_of_a_day_are_bounded(spark, rows, tmp_path):
    data = [("A", float(k), date(2024, 1, 1)) for k in range(100)] + [("B", None, date(2024, 1, 2)), (None, 1.0, None)]
    where = str(tmp_path / "arrays")
    N.write_json_arrays(rows(data, "ticker string, close double, date date"), where, "date", most=10)
    held = [json.loads(p.read_text()) for p in (tmp_path / "arrays").glob("*/*.txt")]
    assert len(held) >= 10 and max(map(len, held)) <= 30
    assert len(list((tmp_path / "arrays").glob("d=2024-01-01/*.txt"))) > 1
    got = N.read_json_array(spark, f"{where}/*", schemas._schema("ticker string, close double, date date"))
    assert sorted(map(str, got.collect())) == sorted(map(str, rows(data, "ticker string, close double, date date").collect()))

"""A key that holds most of a batch is split over tasks, and nothing is lost."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from sieveline import config as C
from sieveline.operators import dedupe, gate as G
from sieveline.session import scratch_dir

NOW = datetime(2026, 6, 30, 12, 0, tzinfo=timezone.utc)
N = 200_000

SMALL_PARTITIONS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skewed(spark):
    """Stored bars, a third of one symbol and day, and a store that knows this key."""
    before = {k: spark.conf.get(k, None) for k in SMALL_PARTITIONS}
    for name, value in SMALL_PARTITIONS.items():
        spark.conf.set(name, value)
    root = scratch_dir(spark, "skew")
    hot = F.col("id") % 3 == 0
    (
        spark.range(0, N, 1, 16)
        .select(
            F.when(hot, "HOT").otherwise(F.concat(F.lit("T"), F.col("id"))).alias("ticker"),
            F.lit("2026-06-30").alias("date"), F.lit(10.0).alias("open"), F.lit(11.0).alias("high"),
            F.lit(9.0).alias("low"), F.lit(10.0).alias("close"), F.lit(1).cast("bigint").alias("volume"),
            F.col("id").alias("seq"), F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        .write.parquet(f"{root}/raw")
    )
    known = [("HOT", date(2026, 6, 30)), *[(f"T{i}", date(2026, 6, 30)) for i in range(0, 3000)]]
    spark.createDataFrame(known, "ticker string, date date").write.parquet(f"{root}/known")
    yield spark.read.parquet(f"{root}/raw"), spark.read.parquet(f"{root}/known")
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def executed(df) -> str:
    """The plan after a run, without the plan it started from."""
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("unique", [True, False])
def test_hot_key_of_the_lookup_is_split(skewed, unique):
    raw, known = skewed
    gated = G.gate(raw, C.RULES["stocks"], NOW, known, verified_unique=unique).drop("payload")
    rows = gated.collect()
    assert "skew=true" in executed(gated)
    assert len(rows) == N
    expected = sum(1 for i in range(N) if i % 3 == 0 or i < 3000)
    assert sum(r.failure_code == C.DUPLICATE for r in rows) == expected


def test_copies_of_a_hot_key_in_one_batch(skewed):
    raw, _ = skewed
    gated = G.gate(raw, C.RULES["stocks"], NOW, intra_batch="seq")
    counts = {r.failure_code: r["count"] for r in gated.groupBy("failure_code").count().collect()}
    copies = (N + 2) // 3 - 1
    assert counts == {None: N - copies, C.DUPLICATE: copies}


def test_latest_of_a_hot_key_moves_one_row_per_task(skewed):
    raw, _ = skewed
    latest = dedupe.upsert_latest(raw.select("ticker", "seq"), ["ticker"], ["seq"])
    hot = [r.seq for r in latest.filter("ticker = 'HOT'").collect()]
    assert hot == [N - 1 - (N - 1) % 3]
    assert latest.count() == N - (N + 2) // 3 + 1

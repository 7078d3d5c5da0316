"""Trailing averages over the last n rows of each key.

A window partitioned by key alone puts a whole key into one task. Here each key is
cut into time buckets, and every bucket also gets copies of the few rows (at most
n - 1) that precede it. The window over (key, bucket) then sees every frame in full, so
the result equals the single window over the key while the largest group is one bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

MOST_PARTS = 4096  # of one key: a sketch of so many quantiles; beyond, parts hold more rows
STRIDE = 64


def _preceding(df: DataFrame, key: str, order: Sequence[str], value: str, reach: int) -> DataFrame:
    """Per (key, bucket): up to ``reach`` rows that precede the bucket, order and value only."""
    bucket = Window.partitionBy(key, "_bucket").orderBy(*[F.col(c).desc() for c in order])
    # Limited on the map side: at most ``reach`` rows per bucket and task are shuffled, and
    # no array below holds more.
    ends = df.select(key, "_bucket", *order, value).withColumn("_back", F.row_number().over(bucket))
    tails = (
        ends.filter(F.col("_back") <= reach)
        .groupBy(key, "_bucket")
        .agg(F.sort_array(F.collect_list(F.struct("_back", *order, value))).alias("_tail"))
    )
    # Every bucket present holds a row, so ``reach`` earlier buckets always suffice.
    earlier = Window.partitionBy(key).orderBy("_bucket").rowsBetween(-reach, -1)
    newest_first = F.flatten(F.reverse(F.collect_list("_tail").over(earlier)))
    gathered = tails.select(key, "_bucket", F.slice(newest_first, 1, reach).alias("_before"))
    return gathered.select(key, "_bucket", F.inline("_before")).drop("_back")


def _cut_points(df: DataFrame, key: str, at: Column, most_rows: int) -> DataFrame | None:
    """(key, _cuts): for keys of more than ``most_rows`` rows the times that cut them into even parts; None without such keys.

    Counts and sketches are map-side combined; the sketches are taken of the heavy keys only. A part may exceed its share by the
    sketch's error, one row in ten thousand of the key.
    """
    sizes = df.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > most_rows)
    largest = sizes.agg(F.max("_n")).first()[0]
    if largest is None:
        return None
    parts = min(ceil(2 * largest / most_rows), MOST_PARTS)
    quantiles = F.percentile_approx(at, [i / parts for i in range(1, parts)], 10_000)
    cuts = df.join(sizes, key, "left_semi").groupBy(key).agg(F.array_sort(F.array_distinct(quantiles)).alias("_cuts"))
    return cuts


def _part(cuts: Column, at: Column) -> Column:
    """How many cut points lie before a time: first among every STRIDE-th of them, then among the STRIDE that follow."""
    coarse = F.size(F.filter(cuts, lambda c, i: (i % STRIDE == STRIDE - 1) & (c < at)))
    fine = F.size(F.filter(F.slice(cuts, coarse * STRIDE + 1, F.lit(STRIDE)), lambda c: c < at))
    return coarse * STRIDE + fine


def trailing_averages(
    df: DataFrame,
    frames: Mapping[str, int],
    key: str = "ticker",
    order: Sequence[str] = ("date",),
    value: str = "close",
    bucket: str = "year",
    most_rows: int = 1_000_000,
) -> DataFrame:
    """Add one column per entry of ``frames`` (name -> number of rows, current row included).

    ``order`` must be unique within a key; its first column is a date or timestamp,
    cut by ``bucket`` (any unit of ``date_trunc``). For one bar a day a year is right; for
    ticks take a unit that holds some thousand rows. With ``bucket="size"`` no unit is needed: keys of
    more than ``most_rows`` rows are cut where their own rows lie, about ``most_rows`` / 2 to a part, the others
    stay whole; that takes a count of the keys first. Nulls in ``value`` count as rows of
    the frame but not in the average.
    """
    reach = max(frames.values()) - 1
    if bucket == "size":
        at = F.unix_micros(F.col(order[0]).cast("timestamp"))
        cuts = _cut_points(df, key, at, most_rows)
        if cuts is None:
            rows, reach = df.withColumns({"_bucket": F.lit(0), "_own": F.lit(True)}), 0
        else:
            cut = df.join(cuts, key, "left")
            part = F.when(F.col("_cuts").isNotNull(), _part(F.col("_cuts"), at))
            rows = cut.withColumns({"_bucket": part, "_own": F.lit(True)}).drop("_cuts")
    else:
        rows = df.withColumns(
            {"_bucket": F.date_trunc(bucket, F.col(order[0]).cast("timestamp")), "_own": F.lit(True)}
        )
    if reach > 0:
        before = _preceding(rows.filter(F.col("_bucket").isNotNull()), key, order, value, reach).withColumn("_own", F.lit(False))
        rows = rows.unionByName(before, allowMissingColumns=True)
    window = Window.partitionBy(key, "_bucket").orderBy(*[F.col(c) for c in order])
    averaged = rows.withColumns(
        {name: F.avg(value).over(window.rowsBetween(-(size - 1), 0)) for name, size in frames.items()}
    )
    return averaged.filter("_own").select(*df.columns, *frames)

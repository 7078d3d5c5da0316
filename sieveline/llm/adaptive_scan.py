"""Nearest neighbours by inverted lists and an adaptive scan of dimensions.

Vectors are scaled to unit length, rotated by one random orthogonal matrix and assigned to the
nearest of the list centroids (fitted on a bounded sample; every row is indexed). A query probes the
lists whose centroids are nearest, as many as ``probe`` asks for and until they hold enough rows.
Within a list vectors lie in column blocks. After a rotation the distance over the first d of D
dimensions, scaled by D / d, estimates the whole distance with an error that falls as
1 / sqrt(d): a candidate is abandoned as soon as the estimate exceeds the query's current
k-th distance by more than the test allows. Survivors get the exact cosine of the
original vectors in double precision.

Work is dealt by (list, block of candidates, block of queries), so a list that holds a third of
all rows spreads over many tasks; each task gives its own k nearest and the query's k
nearest of those are kept.

Row rules: vectors that are null, empty, zero, of another length than most, or with null or
non-finite components take no part, neither as queries nor as candidates; nor do rows with a null
id. Rows with equal ids are candidates each, but never for a query with that id, and ask as one query. Equal scores go to
the smaller id. A query with fewer candidates than k gets all of them; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sieveline.llm.common import stored

ERROR = 2.1  # width of the test, in units of 1 / sqrt(dimensions seen)
SMALL_SIDE = 500_000  # blocks whose counts may be broadcast
STEP = 16  # columns looked at between tests


def _rotation(n: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(n).normal(size=(n, n)))
    return q * np.sign(np.diag(r))


def _centroids(sample: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from evenly spread sample rows."""
    centre = sample[np.linspace(0, len(sample) - 1, min(lists, len(sample))).astype(int)].copy()
    centre = np.unique(centre, axis=0)
    for _ in range(rounds):
        near = np.argmax(sample @ centre.T, axis=1)
        sums = np.zeros_like(centre)
        np.add.at(sums, near, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centre = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), centre)
    return centre


def _probes(sample: np.ndarray, centre: np.ndarray, k: int, target: float, queries: int = 512) -> int:
    """How many lists hold the share ``target`` of the k nearest, for queries from the sample."""
    asked = sample[:: max(1, len(sample) // queries)][:queries]
    near = asked @ sample.T
    near[near > 1 - 1e-12] = -2  # the query itself and its copies
    best = np.argsort(-near, axis=1, kind="stable")[:, :k]
    rank = np.argsort(np.argsort(-(asked @ centre.T), axis=1, kind="stable"), axis=1, kind="stable")
    of = np.argmax(sample @ centre.T, axis=1)[best]
    return int(np.quantile(np.take_along_axis(rank, of, axis=1), target)) + 1


def valid(vector: Column) -> Column:
    """A vector that can take part: finite components, none null, not all zero."""
    return F.coalesce(
        (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    largest = np.abs(x).max(axis=1, keepdims=True)  # first, so that tiny and huge components don't vanish in the squares
    x = x / largest
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def scan(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Survivors (query place, row place) of the adaptive scan of unit vectors, rotated; ids ascend.

    All rows are dealt with in blocks of columns; a query's bound is the k-th distance of its first rows,
    made smaller as later slices are done.
    """
    width = rows.shape[1]
    found_q, found_r = [], []
    bound = np.full(len(queries), np.inf)
    best = np.full((len(queries), k), np.inf)
    slices = np.unique(np.concatenate([[0], np.arange(min(256, len(rows)), len(rows), 1024), [len(rows)]]))
    for a, b in zip(slices[:-1], slices[1:], strict=True):
        q, r = np.nonzero(query_ids[:, None] != ids[None, a:b])
        r = r + a
        partial = np.zeros(len(q))
        for d in range(0, width, STEP):
            if d == 0:  # the first block of all pairs at once
                x, y = queries[:, :STEP], rows[a:b, :STEP]
                first = (x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T
                partial = np.maximum(first[q, r - a], 0)
            else:
                gap = queries[q, d : d + STEP] - rows[r, d : d + STEP]
                partial = partial + np.einsum("ij,ij->i", gap, gap)
            seen = min(d + STEP, width)
            if seen < width:
                allowed = bound[q] * (1 + ERROR / np.sqrt(seen)) ** 2
                stay = partial * (width / seen) <= allowed
                q, r, partial = q[stay], r[stay], partial[stay]
        stay = partial <= bound[q] * (1 + 1e-9) + 1e-12
        q, r, partial = q[stay], r[stay], partial[stay]
        found_q.append(q)
        found_r.append(r)
        # New bounds: the k smallest of the old ones and this slice's.
        order = np.lexsort((partial, q))
        place = np.arange(len(order)) - np.searchsorted(q[order], q[order])
        top = order[place < k]
        grid = np.full((len(queries), k), np.inf)
        grid[q[top], place[place < k]] = partial[top]
        best = np.sort(np.concatenate([best, grid], axis=1), axis=1)[:, :k]
        bound = best[:, -1]
    q, r = np.concatenate(found_q) if found_q else np.zeros(0, int), np.concatenate(found_r) if found_r else np.zeros(0, int)
    return q, r


def _dealt(asked: DataFrame, rows: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Queries and rows by (list, block, part): a block that many queries visit has parts, each with some of the queries and
    all its rows; the rows of other blocks are not copied, those that no query visits go."""
    parts = asked.groupBy("list", "block").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("parts"))
    parts = stored(parts, "ann-parts")
    parts = F.broadcast(parts) if parts.limit(SMALL_SIDE + 1).count() <= SMALL_SIDE else parts
    of_query = F.pmod(F.xxhash64("id", F.lit(7)), F.col("parts")).cast("int").alias("part")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    columns = ["id", "v", "list", "block"]
    return asked.join(parts, ["list", "block"]).select(*columns, of_query), rows.join(parts, ["list", "block"]).select(*columns, every)


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    lists: int | None = None,
    probe: float | None = None,
    target: float = 0.97,
    sample_rows: int = 20_000,
    block_rows: int = 8192,
) -> DataFrame:
    """(query_id, rank, <id_col>, score): the k nearest found by cosine, for the rows where ``is_query`` holds.

    ``lists``: number of inverted lists, by default the square root of the rows (1024 at most). ``probe``:
    share of the lists each query visits; by default the smallest that holds the share ``target`` of the sample's
    own nearest neighbours. ``sample_rows`` bounds what centroids and that share are fitted on; all rows are indexed.
    """
    usable = df.where(F.col(id_col).isNotNull() & valid(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: x.cast("double")).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")
    )
    result = f"query_id long, rank int, {id_col} long, score double"
    spark = df.sparkSession
    usual = usable.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if usual is None:
        return spark.createDataFrame([], result)
    width, total = usual
    usable = usable.where(F.size("v") == width)
    sample = usable.select("v").orderBy(F.xxhash64("id"), "id").limit(sample_rows).toArrow().column("v").combine_chunks()
    lists = lists or max(1, min(1024, int(total**0.5)))
    rotation = _rotation(width)
    sample = _unit(_matrix(sample)) @ rotation
    centre = _centroids(sample, lists)
    probes = max(1, round(probe * len(centre))) if probe is not None else _probes(sample, centre, k, target)
    shared = spark.sparkContext.broadcast((rotation, centre))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotation, centre = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(_matrix(batch.column(1))) @ rotation
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.argmax(x @ centre.T, axis=1).astype(np.int32))], names=["id", "v", "q", "list"])

    placed = stored(usable.mapInArrow(assign, "id long, v array<double>, q boolean, list int"), "ann-index")
    sizes = {r.list: r["count"] for r in placed.groupBy("list").count().collect()}  # one row per list
    counts = np.array([sizes.get(j, 0) for j in range(len(centre))])
    blocks = np.maximum(1, -(-counts // block_rows))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query once for every block of every list it probes."""
        rotation, centre = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(_matrix(batch.column(1))) @ rotation
            order = np.argsort(-(x @ centre.T), axis=1, kind="stable")
            held = np.cumsum(counts[order], axis=1)
            # The probed lists, and more of them until k rows besides the query itself lie in them.
            need = np.maximum(probes, (held < k + 1).sum(axis=1) + 1)
            at, rank = np.nonzero(np.arange(len(centre))[None] < need[:, None])
            lists_ = order[at, rank]
            times = np.where(counts[lists_] > 0, blocks[lists_], 0)
            place = np.repeat(at, times)
            block = np.arange(len(place)) - np.repeat(np.cumsum(times) - times, times)
            taken = batch.take(pa.array(place))
            yield pa.RecordBatch.from_arrays([taken.column(0), taken.column(1), pa.array(np.repeat(lists_, times).astype(np.int32)), pa.array(block.astype(np.int32))], names=["id", "v", "list", "block"])

    of_list = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("list") + 1)
    rows = placed.select("id", "v", "list", F.pmod(F.xxhash64("id"), of_list).cast("int").alias("block"))
    # Many queries may visit a list: they are split too, and the list's rows given to each part.
    asked = placed.where("q").select("id", "v").mapInArrow(visit, "id long, v array<double>, list int, block int")
    asked = stored(asked, "ann-visits")
    asked, rows = _dealt(asked, rows, block_rows)

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rotation, _ = shared.value
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        right = right.sort_values("id", kind="stable")
        x, y = np.stack(left["v"].to_numpy()), np.stack(right["v"].to_numpy())
        ux, uy = _unit(x), _unit(y)
        q_ids, ids = left["id"].to_numpy(), right["id"].to_numpy()
        out = []
        rx, ry = ux @ rotation, uy @ rotation
        for a in range(0, len(x), 256):
            q, r = scan(rx[a : a + 256], q_ids[a : a + 256], ry, ids, k)
            q = q + a
            score = np.einsum("ij,ij->i", ux[q], uy[r])
            order = np.lexsort((ids[r], -score, q))
            place = np.arange(len(order)) - np.searchsorted(q[order], q[order])
            top = order[place < k]
            out.append(pd.DataFrame({"query_id": q_ids[q[top]], "vec": ids[r[top]], "score": score[top]}))
        return pd.concat(out)

    key = ["list", "block", "part"]
    found = asked.groupBy(*key).cogroup(rows.groupBy(*key)).applyInPandas(search, "query_id long, vec long, score double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec").alias(id_col), "score")

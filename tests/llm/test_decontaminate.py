import math
import random
import re

import duckdb
import pytest

from sieveline.llm import decontaminate as dc


def shingles(text, width):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    if not ws:
        return set()
    return {tuple(ws[i : i + width]) for i in range(max(1, len(ws) - width + 1))}


def brute(docs, items, containment, width):
    best = {}
    for d, dt in docs:
        have = shingles(dt, width)
        for i, it in items:
            want = shingles(it, width)
            if want and len(want & have) >= math.ceil(containment * len(want) - 1e-9):
                value = (len(want & have), len(want))
                best[d, i] = max(best.get((d, i), (0, 0)), value)
    return {(d, i, s, n) for (d, i), (s, n) in best.items()}


def result(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("containment, width", [(0.8, 5), (0.5, 3), (1.0, 2)])
def test_equal_to_brute_force(spark, rows, containment, width):
    pick = random.Random(11)
    word = lambda: f"w{pick.randrange(90)}"
    items = [(i, " ".join(word() for _ in range(pick.choice([1, 3, 5, 6, 12, 40, 70])))) for i in range(40)]
    docs = []
    for d in range(200):
        ws = [word() for _ in range(pick.choice([0, 2, 30, 300, 2000]))]
        for _ in range(pick.choice([0, 1, 1, 3])):
            part = pick.choice(items)[1].split()
            cut = pick.choice([0, 0, 1, len(part) // 5, len(part) // 3])
            part = part[cut:]
            if len(part) > 3 and pick.random() < 0.4:
                part[pick.randrange(len(part))] = "CHANGED"
            at = pick.randrange(len(ws) + 1)
            ws[at:at] = part
        docs.append((d, "\n\t ".join(ws).upper() if d % 3 else " ".join(ws)))
    got = dc.find(rows(docs, "doc_id long, text string"), rows(items, "item_id long, text string"), containment, width)
    want = brute(docs, items, containment, width)
    assert want and result(got) == want


def test_odd_rows(spark, rows):
    text = "one two three four five six seven"
    docs = [(1, text, "x"), (1, text, "x"), (1, "other", "x"), (2, None, "x"), (3, "", "x"), (None, "zero " + text, "x"), (4, "word " * 50_000 + text, "x"), (5, "short item", "x"), (6, "a short item", "x")]
    items = [(10, text, 1), (10, text, 1), (11, None, 1), (12, " \n", 1), (13, "Short  item", 1), (None, "word word word word word", 1)]
    d, i = rows(docs, "doc_id long, text string, n_shared string"), rows(items, "item_id long, text string, h int")
    assert result(dc.find(d, i)) == brute([r[:2] for r in docs], [r[:2] for r in items], 0.8, 5)
    kept = dc.clean(d, i).collect()
    assert sorted((r.doc_id for r in kept)) == [1, 2, 3, 6] and kept[0].n_shared == "x"
    none = rows([], "doc_id long, text string"), rows([], "item_id long, text string")
    assert dc.find(none[0], i).count() == 0 and dc.find(d, none[1]).count() == 0
    assert dc.clean(d, none[1]).count() == len(docs)


def test_clean_judges_rows_one_by_one(spark, rows):
    text = "one two three four five six seven"
    docs = [(None, "zero " + text, 1), (None, "a clean text", 2), (None, None, 3), (None, "", 4), (1, text, 5), (1, "another clean text", 6), (2, "clean", 7)]
    d, i = rows(docs, "doc_id long, text string, Key int"), rows([(10, text)], "item_id long, text string")
    got = dc.clean(d, i)
    assert got.columns == ["doc_id", "text", "Key"] and sorted(r.Key for r in got.collect()) == [2, 3, 4, 6, 7]
    named = rows([(10, text)], "doc string, text string")
    assert dc.clean(d.withColumnRenamed("Key", "held"), named, item_id="doc").count() == 5


def test_partitions_by_size(spark, rows):
    """A document looks nothing up in partitions whose items it is too small for, and all within the bound in the others."""
    from pyspark.sql import functions as F

    sketch = rows([(1, 7, list(range(0, 100, 10))), (2, 7, [5, 95]), (3, 7, [5])], "doc long, k long, all array<long>")
    got = {(r.doc, r.h) for r in dc.lookups(sketch, {1: 30, 3: 70}, 0.8).collect()}
    assert got == {(1, h) for h in range(0, 71, 10)} | {(2, 5)}  # 8 items' shingles ask for 7, 2 for 2
    met = rows([(1, 10, 3), (1, 6, 3), (1, 2, 1), (1, 1, 1)], "doc long, size int, size_class int")
    assert [r.size for r in met.where(dc._large_enough([1, 3], 0.8)).orderBy(F.desc("size")).collect()] == [10, 2]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_tables_equal_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    got = dc.find(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/benchmark.parquet"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{path}/{t}.parquet'")
    want = con.execute(dc.oracle()).fetchall()
    assert want and result(got) == set(want)


def test_plan_is_native(spark, rows):
    df = dc.find(rows([(1, "a b c d e f")], "doc_id long, text string"), rows([(1, "a b c d e f")], "item_id long, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan

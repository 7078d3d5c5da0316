"""The registered queries: all there, whole tables, equal to their SQL where there is one."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from check_oracles import rows_of
from sieveline.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    names = {n.split("_")[0] for n in QUERIES}
    assert names == {f"op{k}" for k in range(1, 14)} | {"pipeline"}
    assert QUERIES.keys() <= queries().keys() and ORACLES.keys() <= oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cursor = con.execute(ORACLES[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op8_adaptive_scan", "op10_decontaminate", "op11_whitening", "op13_source_divergence", "pipeline"}))
def test_one_row_per_document(spark, name):
    df = QUERIES[name](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(r.doc_id for r in df.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())

"""Queries with SQL give the rows DuckDB gives."""

import duckdb
import pytest

from curalis.operators import quality
from curalis.plans import catalog
from curalis.plans import pipeline as P
from tests.conftest import DATA

TABLES = "orders documents customer".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_matches_sql(spark, con, name):
    want = con.sql(catalog.ORACLE[name])
    columns = sorted(want.columns)
    rows = sorted(map(str, (tuple(r[want.columns.index(c)] for c in columns) for r in want.fetchall())))
    got = catalog.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == columns
    assert sorted(str(tuple(r[c] for c in columns)) for r in got.collect()) == rows


def test_stream(spark, tmp_path):
    from curalis.sources.notes import from_orders
    from curalis.streaming.notes import curate

    from_orders(spark, DATA).limit(20).write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).parquet(f"{tmp_path}/in")
    q = curate(source).select("record_id", "exam_anon").writeStream.format("memory").queryName("curated").option("checkpointLocation", f"{tmp_path}/cp").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("curated").count() == 20


def test_entry_imports():
    import __spark_entry__ as e

    assert set(catalog.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_labels_need_no_flags(spark, monkeypatch):
    """Queries on labels write nothing and have the labels of the flagged notes."""
    notes = catalog.a(spark, DATA)
    want = {tuple(map(str, r)) for r in P.enriched(notes).select("record_id", "mecanismo_lesion", "region_anatomica", "desenlace", "abreviaturas").collect()}
    monkeypatch.setattr(quality, "flags", None)
    got = P.labelled(notes).select("record_id", "mecanismo_lesion", "region_anatomica", "desenlace", "abreviaturas").collect()
    assert {tuple(map(str, r)) for r in got} == want and len(got) == notes.count()
    assert catalog.QUERIES["classify_outcome"](spark, DATA).columns == ["record_id", "desenlace", "abreviaturas"]

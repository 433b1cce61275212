"""The pipeline and the registered queries over small whole tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from blotter.llm.oracle import ORACLE

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages_keep_the_columns_and_act(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns, name
        ids = [r["doc_id"] for r in after.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= {r["doc_id"] for r in before.select("doc_id").collect()}
        before = spark.createDataFrame(after.collect(), docs.schema)
    texts = [r["text"] for r in before.collect()]
    assert len(texts) == len(set(texts)) < docs.count()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in before.collect()}
    assert not [i for i in kept if labels.get(i) == 0][3:]
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == kept


def test_one_query_per_operator():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert len([k for k in names if k.startswith(f"op{n}_")]) == 1


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for t in ("pages", "conversations", "documents"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    expected = con.execute(ORACLE[name]).fetchdf()
    columns = sorted(expected.columns)
    got = __spark_entry__.queries()[name](spark, SF).select(*columns).collect()
    norm = lambda x: None if x is None or x != x else str(x).removesuffix(".0")
    rows = sorted(str([norm(v) for v in r]) for r in got)
    assert rows == sorted(str([norm(v) for v in r]) for r in expected[columns].astype(object).itertuples(index=False))


def test_stages_on_odd_rows_and_names(spark):
    """Null texts and ids, empty texts, repeated rows, and columns named like our own."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (10**6, "", "en", "s", 0), (10**6, "", "en", "s", 0), (10**6 + 1, None, "en", "s", None)],
        docs.schema,
    )
    names = {c: F.lit(1) for c in ("_v", "_p", "v", "p", "row", "_place", "_gone", "keep", "accepted", "length")}
    given = docs.union(odd).withColumns(names)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, given, SF).columns == given.columns, name
        one = stage(spark, given, SF)
        assert {r["_v"] for r in one.select("_v").distinct().collect()} <= {1}, name
    packed = corpus_pipeline.STAGES[-1][1](spark, given, SF)
    assert packed.where("doc_id is null").count() == 1


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name

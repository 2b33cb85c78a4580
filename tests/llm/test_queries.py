"""The registered queries on the small tables: against SQL where there is some, and the pipeline stage by stage."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import ROOT, SF_SMALL
from strata.llm.oracle import ORACLE_SQL
from strata.llm.queries import QUERIES
from strata.sources.checkpoint import materialize
from tests.llm.fixtures import ODD_DOCS, odd_docs

sys.path.insert(0, os.path.join(ROOT, "tools"))
from check_oracle import TABLES, digest  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF_SMALL).toPandas(), con.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and digest(got)[0] == digest(want)[0]


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def staged(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, "unused"))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        yield name, docs, out
        docs = out


def test_stages(spark):
    rows = {}
    for name, before, after in staged(spark, materialize(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))):
        rows[name] = (before.count(), after.count())
        if name == "near_dup":
            assert after.select("text").distinct().count() == after.count()
        if name == "personal_data":
            assert after.where(F.col("text").rlike(r"[A-Za-z0-9]@[A-Za-z0-9]+\.|token = .[0-9a-f]{20}") | (F.length("text") != F.col("n_chars"))).count() == 0
        if name == "mixing":
            assert after.groupBy("doc_id").count().where("count > 3").count() == 0
    assert rows["language"][0] == rows["language"][1] and rows["near_dup"][1] < rows["near_dup"][0] and rows["bpe"][0] == rows["bpe"][1] > 0


def test_stages_on_odd_rows(spark):
    names = ["_salt", "_key", "_text", "_spans", "_doc", "_id", "_tag", "_s", "_size", "doc", "copy"]
    docs = odd_docs(spark)
    docs = materialize(docs.withColumns({n: F.lit("old") for n in names}))
    old = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    sizes = {name: (before.count(), after.count()) for name, before, after in staged(spark, docs)}
    assert sizes["language"][0] == len(ODD_DOCS) and sizes["bpe"][1] > 0
    for name, _, after in staged(spark, docs):
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.where(" or ".join(f"`{c}` is null or `{c}` <> 'old'" for c in old)).count() == 0
    for _, _, after in staged(spark, docs.limit(0)):
        assert after.count() == 0

"""The driver contract: entry() and every registered query against its
DuckDB oracle, on the smallest test tables."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402
from strata.plans.oracle import oracle_queries  # noqa: E402
from strata.plans.queries import QUERIES  # noqa: E402


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_unique_id", "customer_city", "total_orders", "total_items",
                          "total_spent", "customer_rank"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_queries()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(oracle_queries()))
def test_query_matches_oracle(spark, duck, name):
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    od = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(od.columns)
    assert len(sp) == len(od)
    assert digest(sp)[0] == digest(od)[0]


def test_clear_layers_rebuilds(spark):
    from strata.plans import layers
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)
    a = layers.stored_layer(spark, "/nowhere", "probe", build)
    layers.stored_layer(spark, "/nowhere", "probe", build)
    assert len(calls) == 1 and a.count() == 3
    layers.clear_layers(spark)
    layers.stored_layer(spark, "/nowhere", "probe", build)
    assert len(calls) == 2


def test_replaced_sources_rebuild_layers(spark, tmp_dir):
    from strata.plans import layers

    def total():
        return layers.stored_layer(spark, tmp_dir, "probe", lambda: spark.read.parquet(f"{tmp_dir}/t.parquet")).count()
    spark.range(3).write.parquet(f"{tmp_dir}/t.parquet")
    assert total() == 3 == total()
    spark.range(30).write.mode("overwrite").parquet(f"{tmp_dir}/t.parquet")
    assert total() == 30
    assert E.queries()["G1"](spark, SF_SMALL).count() == 150

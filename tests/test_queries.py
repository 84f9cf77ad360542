"""Every registered query against its DuckDB oracle.

Runs at the smoke scale; set ``TIERKIT_ORACLE_SF_DIR`` (e.g.
``/root/testdata/sf0.01``) to run the same gate at another scale.
"""

import os

import pytest

import __spark_entry__ as entry_mod
from helpers import SMOKE_DIR
from oracle import compare, duck
from tierkit.queries import ORACLE_SQL, QUERIES

NAMES = sorted(QUERIES)
SF_DIR = os.environ.get("TIERKIT_ORACLE_SF_DIR", SMOKE_DIR)


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_mod.queries())
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, entry_mod.queries()[name], entry_mod.oracle_sql()[name], SF_DIR)
    assert res["columns_match"], res["columns"]
    assert res["rows"][0] == res["rows"][1], res["rows"]
    assert res["values_match"]


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["table_name", "k", "v", "x"]
    assert df.select("table_name").distinct().count() == 5


def test_full_run_refines_ids_as_wide_as_their_tables(spark, tmp_path):
    # Ids of many users and events: beyond two and four bytes, as its SQL tells them.
    events = spark.read.parquet(f"{SMOKE_DIR}/events.parquet").limit(40)
    events = events.selectExpr("event_id + 3000000000 event_id", "ts", "user_id + 40000 user_id", "event_type", "value", "props")
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.read.parquet(f"{SMOKE_DIR}/part.parquet").write.parquet(f"{tmp_path}/part.parquet")
    got = QUERIES["full_run"](spark, str(tmp_path)).where("table_name = 'silver_positions'")
    want = events.selectExpr("cast(user_id as string) k", "cast(event_id as string) v", "ts").groupBy("k").agg({"ts": "count"})
    assert sorted(r["k"] for r in got.collect()) == sorted(r["k"] for r in want.collect())
    assert all(int(r["v"]) >= 3000000000 for r in got.collect())

"""Every query with DuckDB SQL gives the same rows in both engines."""

import os

import pytest

from placewright.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(map(repr, df.where(df.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, DATA).toPandas()
    if name in registry.oracles():
        want = duck.execute(registry.oracles()[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_routes_lead_to_their_outcomes(spark):
    got = registry.queries()["final_choice_router"](spark, DATA).toPandas()
    assert len(got) == spark.read.parquet(f"{DATA}/customer.parquet").count() and got.record_id.is_unique
    assert set(got[got.route == "placeholder"].map_match_status) == {"skipped"} and set(got[got.route == "placeholder"].final_address) == {""}
    assert set(got[got.route == "valid"].final_address_source) == {"official"}
    assert (got[got.map_match_status == "poi_match"].final_address == got[got.map_match_status == "poi_match"].map_address).all()
    assert set(got[got.map_match_status == "conflict"].final_address_source) <= {"official"}

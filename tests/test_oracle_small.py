"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from shopflow import catalog
from shopflow.sources.tables import BASE_TABLES
from tests.conftest import SF_SMALL
from tools.check_oracle import digest

STREAMS = {k for k in catalog.QUERIES if k.startswith("stream_")}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLES) == set(catalog.QUERIES) and set(catalog.QUERIES) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["area", "area_level", "product_id", "city_infos", "click_count", "product_name",
                          "product_status"]


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - STREAMS))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


@pytest.mark.parametrize("name", sorted(STREAMS))
def test_stream_matches_oracle(spark, con, name):
    test_query_matches_oracle(spark, con, name)

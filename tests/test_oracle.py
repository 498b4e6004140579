"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.oracle_check import _rows, type_mismatches
from wrenchcast.plans.registry import ORACLE, QUERIES
from wrenchcast.plans.tables import TABLES

from .conftest import SF_SMALL

KEYS = sorted(QUERIES)  # those of the optional subpackage are tested beside it


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["asset_id", "day", "avg_sensor", "flighthours", "flightcycles",
                          "delayedminutes", "label"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    sdf = entry.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLE[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert type_mismatches(sdf.schema, res.description) == []
    assert len(srows) == len(orows)
    assert _rows(sdf.columns, srows, False) == _rows(ocols, orows, False)

"""Every registered query against its DuckDB twin on the smoke tables."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "scripts"))

import __spark_entry__ as entry  # noqa: E402
from pairflow.plans import registry  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

KEYS = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def test_every_query_has_a_twin():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(KEYS) <= set(entry.queries()) and set(KEYS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_dir, duck, key):
    got = entry.queries()[key](spark, sf_dir).toPandas()
    want = duck.execute(entry.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows_of(got) == rows_of(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    # the 40 columns of the reference minus the processed_at_utc audit column
    assert len(df.columns) == 39
    assert df.count() > 0

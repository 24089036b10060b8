"""Every registered query equals its DuckDB oracle (order-insensitive) on
the small tables; the driver repeats this at sf0.01."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import duck, frame_digest  # noqa: E402
from visitlens.plans.oracle import oracle_sql  # noqa: E402
from visitlens.plans.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    got = frame_digest(QUERIES[key](spark, SF_SMALL).toPandas())
    want = frame_digest(con.sql(oracle_sql()[key]).df())
    assert got[0] == want[0], "column names differ"
    assert got[1] == want[1], "row counts differ"
    assert got[2] == want[2], f"values differ: {sorted(set(got[3]) ^ set(want[3]))[:4]}"


def test_optional_queries_are_registered_on_top():
    assert set(QUERIES) <= set(entry.queries()) and set(oracle_sql()) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["metric", "bucket", "bucket_order", "n", "total", "ratio"]
    assert df.count() == 15

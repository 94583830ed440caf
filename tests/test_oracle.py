"""Every registered query against its SQL oracle (DuckDB) on sf0.001:
row count, column names and an order-insensitive value hash."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from clickengine.plans import catalog  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

from tests.conftest import SF_SMALL  # noqa: E402

NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.queries())
    missing = set(NAMES) - set(entry.oracle_sql())
    assert not missing


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["event_type", "cnt", "window_start", "window_end"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, entry.queries()[name], entry.oracle_sql().get(name), SF_SMALL, con)
    assert r["status"] == "ok", r


def test_caller_session_time_zone(spark, con):
    """The driver may bring a session in another zone; queries pin UTC."""
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    for name in ["late_split", "fake_window", "event_time_seconds"]:
        r = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL, con)
        assert r["status"] == "ok", r

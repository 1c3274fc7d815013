"""Every registered query against its SQL."""

import os
import re

import pytest

import __spark_entry__ as entry
from check_queries import compare, connect
from tests.conftest import SF


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


# The document is one text; the test of its numbers is test_dashboard's.
NO_SQL = {"dashboard_json"}
CORE = sorted(name for name in entry.queries() if not re.match(r"op\d+_|pipeline$", name))


def test_every_query_has_sql():
    assert set(CORE) - NO_SQL == {name for name in entry.oracle_sql() if name in CORE}


@pytest.mark.parametrize("name", [name for name in CORE if name not in NO_SQL])
def test_query_equals_sql(spark, duck, name):
    problem, _ = compare(spark, duck, name, SF)
    assert problem is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_session_zone_does_not_matter(spark, duck):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        for name in ("trend_daily", "interval_pairs", "asof_attribution"):
            problem, _ = compare(spark, duck, name, SF)
            assert problem is None, name
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_no_data_in_repository():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, files in os.walk(root):
        assert not [f for f in files if f.endswith((".parquet", ".csv"))], folder

"""Every registered query against its SQL in DuckDB, on the smallest generated tables."""

import os

import pytest

import __spark_entry__ as entry
from tidemart import catalogue
from check import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables are missing")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_sql(spark, duck, name):
    verdict = compare(spark, duck, FOLDER, name, catalogue.queries()[name], catalogue.oracle_sql().get(name))
    assert verdict.startswith("ok"), verdict


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["stt", "edt", "cur_date"] and df.count() > 0

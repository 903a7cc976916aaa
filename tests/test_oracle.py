"""Every registered query against its SQL counterpart on a second engine."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_point  # noqa: E402
from compare import connect, differences  # noqa: E402

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_point.bank_queries()
ORACLES = entry_point.oracles.oracle_sql()


@pytest.fixture(scope="module")
def engine():
    with connect(FOLDER) as con:
        yield con


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, engine, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert differences(got, engine.execute(ORACLES[name]).df()) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() == 3

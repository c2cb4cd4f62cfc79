"""Every query against its SQL on the smallest tables."""

import subprocess
import sys

import pytest

import __spark_entry__ as contract
from tests.compare import assert_same, connect
from tests.conftest import SF_DIR
from tillmart.plans.oracles import oracle_sql
from tillmart.plans.registry import QUERIES

@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, con, name):
    assert assert_same(contract.queries()[name](spark, SF_DIR), con.sql(oracle_sql()[name])) > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_import_needs_no_session():
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)

"""Every registered query against its check SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from compare import difference, duck
from lociflow.plans import queries as registered

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert difference(df, con, entry.oracle_sql()[name]) is None


def test_every_query_of_the_library_has_its_sql():
    assert set(registered.QUERIES) == set(registered.SQL)


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() == 6

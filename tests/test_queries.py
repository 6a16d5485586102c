import os

import pytest

import __spark_entry__ as entry
import compare
from leadloom.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def engine():
    return compare.connect(SF)


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_its_sql(spark, engine, name):
    assert compare.differences(entry.queries()[name](spark, SF), engine, entry.oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()

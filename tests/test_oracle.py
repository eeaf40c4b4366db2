import pytest

import __spark_entry__ as entry_module
from hazardlake.plans.catalog import REGISTRY
from tools.check_oracle import compare, oracle_connection

from .conftest import SF


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_its_sql(spark, oracle, name):
    ok, detail = compare(spark, oracle, name, SF)
    assert ok, detail


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())

"""Every query against its SQL on the smallest test set."""

import pytest

from check_oracles import compare
from conftest import SF
from tripmetrics.plans.catalogue import QUERIES
from tripmetrics.plans.oracles import ORACLES


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, name):
    ok, note = compare(spark, SF, name, ORACLES.get(name))
    assert ok, note

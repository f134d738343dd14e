"""Distributors counted by their key: what counting distinct values shuffles."""

import pytest

from salesmart.plans import marts, screens
from salesmart.sources.tables import Source
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("query", [marts.distributor_vs_internal, screens.dist_kpis])
def test_distributors_are_counted_by_their_key(spark, query):
    plan = query(Source(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    expand = next(i for i, line in enumerate(plan) if "Expand" in line)
    assert not any("distributor_name" in line or "distributor_type" in line for line in plan[expand:])

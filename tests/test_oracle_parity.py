"""Every registered query must return exactly the rows of its oracle SQL."""

import pytest

from __spark_entry__ import oracle_sql, queries
from salesmart.catalog import QUERIES
from tests.conftest import SF_SMALL
from tests.helpers import as_multiset

NAMES = sorted(set(QUERIES) & set(oracle_sql()))  # the others have tests of their own


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sql = oracle_sql()[name]
    got = queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(sql).df()
    gc, gr = as_multiset(got)
    wc, wr = as_multiset(want)
    assert gc == wc
    assert gr == wr


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert "yoy_growth_pct" in df.columns

"""Every registered query against its DuckDB oracle statement.

Runs at ``RIDELAKE_TEST_SF`` (default sf0.001); the driver runs the same
comparison at sf0.01.
"""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare, duck_connect  # noqa: E402

from ridelake.plans import catalog  # noqa: E402

# the optional subpackage's queries have tests of their own
KEYS = list(catalog.queries())


@pytest.fixture(scope="module")
def duck(sf_dir):
    return duck_connect(sf_dir)


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_dir, duck, key):
    qs = entry.queries()
    oracle = catalog.oracle_sql()
    df = qs[key](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # no pairwise joins, no row-at-a-time Python in any registered plan
    assert not [f for f in FORBIDDEN if f in plan], (key, plan)
    res = compare(spark, key, lambda _s, _d: df, oracle.get(key), sf_dir, duck)
    assert res["status"] in ("match", "rows-only"), res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "revenue_monthly_total_amount" in df.columns


def test_every_query_has_an_oracle_or_is_documented():
    rows_only = set(KEYS) - set(catalog.oracle_sql())
    assert not rows_only

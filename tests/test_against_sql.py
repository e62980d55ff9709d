"""Every registered query against its SQL on the smallest test tables, and its plan's shape."""

import pytest

import __spark_entry__ as entry_module
from terrace import registry
from tests.conftest import SMALL, plan_of
from tools.compare import check, connect

ORACLE = registry.ORACLE
QUERIES = {name: registry.runnable(name) for name in registry.QUERIES}
# Fitted models without a closed form: test_models runs them once.
SLOW = {"ml_random_forest", "ml_gbt", "ml_stacking", "ml_feature_importance", "ml_linear_models",
        "ml_leaderboard_models"}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, duck, name):
    difference, _ = check(spark, duck, SMALL, name, QUERIES[name], ORACLE.get(name))
    assert difference is None, difference


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("ml_")])
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in plan


def test_only_models_lack_sql():
    assert set(QUERIES) - set(ORACLE) == SLOW


def test_entry(spark):
    df = entry_module.entry(spark)
    assert "customer_segment" in df.columns and df.count() > 0

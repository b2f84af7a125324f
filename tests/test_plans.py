"""Physical plans: no Python in the data path, no products, no needless shuffles."""

import re

import pytest

from epilink.operators.names import resolve_names
from epilink.operators.geo import resolve_and_geocode
from epilink.plans.catalog import QUERIES, Tables
from epilink.operators import link

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_products(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for operator in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_names_are_resolved_without_a_shuffle(spark):
    t = Tables(spark, FOLDER)
    assert "Exchange hash" not in plan(resolve_names(t.spelled_customers(), "raw"))
    assert "Exchange hash" not in plan(resolve_and_geocode(t.spelled_customers(), "raw"))


def test_small_context_leaves_cases_unshuffled(spark):
    """Cases of a stored table meet the context by broadcast, with no exchange on the way."""
    t = Tables(spark, FOLDER)
    cases = t.cases().where("case_count > 0")
    linked = link.link_sources(cases, t.weather(), t.alerts())
    assert plan(linked).count("Exchange hash") == plan(cases).count("Exchange hash")


def test_context_is_joined_on_its_own_partitioning(spark):
    """Means and alerts are already spread by key, so their join adds no exchange."""
    t = Tables(spark, FOLDER)
    means, alerts = link.weekly_means(t.weather()), link.weekly_alerts(t.alerts())
    exchanges = lambda df: len(re.findall(r"Exchange hash", plan(df)))
    assert exchanges(link.weekly_context(t.weather(), t.alerts())) == exchanges(means) + exchanges(alerts)


def test_scans_read_only_what_they_need(spark):
    text = plan(QUERIES["mean_by"](spark, FOLDER))
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in text
    assert "PushedFilters: [IsNotNull(l_suppkey)]" in text
    alerts = plan(QUERIES["count_by"](spark, FOLDER))
    assert "EqualTo(o_orderpriority,1-URGENT)" in alerts

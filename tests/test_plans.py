"""Plans: filters that reach the scan, aggregation before the shuffle, no shuffle where none is due."""

import os

import pytest

from sluice.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


def test_recent_users_has_no_outer_join_and_one_shuffle_per_side(spark):
    text = plan(QUERIES["recent_users"](spark, SF))
    assert "Outer" not in text and "LeftOuter" not in text
    assert text.count("Exchange hashpartitioning") == 2
    assert "partial_max" in text


def test_slice_reaches_the_scan(spark):
    text = plan(QUERIES["since_slice"](spark, SF))
    assert "GreaterThan(ts,2024-01-10T12:00" in text and "LessThanOrEqual(ts,2024-01-20T00:00" in text
    assert "Exchange" not in text


def test_upsert_combines_before_the_shuffle(spark):
    text = plan(QUERIES["upsert_last_wins"](spark, SF))
    assert "partial_max" in text and "LeftAnti" in text
    assert "Window" not in text
    assert "GreaterThan(o_orderdate" in text


def test_flattening_needs_no_shuffle(spark):
    for name in ("explode_items", "explode_nested", "explode_summaries", "period_fallback", "people_json",
                 "descriptions_array", "programmes_per_student", "pseudonym", "text_cuts", "link_header"):
        assert "Exchange" not in plan(QUERIES[name](spark, SF)), name

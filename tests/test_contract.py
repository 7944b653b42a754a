"""The driver contract: every registered query runs and equals its SQL oracle."""

import pytest

import __spark_entry__ as E
from wellspring.plans.oracle import ORACLE
from wellspring.plans.registry import QUERIES
from compare import compare

KEYS = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 25  # (province, town) pairs; town labels repeat
    assert df.columns == ["province_name", "town_name", "river", "shared_tap", "tap_in_home",
                          "tap_in_home_broken", "well"]


@pytest.fixture(scope="module")
def small_report(spark, sf_small):
    return compare(spark, sf_small)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(small_report, key):
    assert small_report[key]["ok"], small_report[key]


# Anchor counts at sf0.01 (from the role mapping, computed independently).
ANCHORS = {
    "combined_view": 8590,
    "work_orders": 4277,
    "audit_match_first": 2847,
    "audit_mismatch": 5743,
    "filter_contradiction": 79,
    "filter_like_prefix": 125,
    "town_source_share": 25,
    "filter_gt": 1175,
    "mistakes_per_employee": 100,
    "suspect_list": 52,
}


@pytest.mark.parametrize("key,n", sorted(ANCHORS.items()))
def test_anchor_counts(spark, sf_mid, key, n):
    assert QUERIES[key](spark, sf_mid).count() == n


def test_queries_are_independent_when_built_before_collecting(spark, sf_small, small_report):
    frames = {k: fn(spark, sf_small) for k, fn in QUERIES.items()}
    counts = {k: df.count() for k, df in frames.items()}
    assert counts == {k: small_report[k]["rows"] for k in frames}


def test_more_role_anchors(spark, sf_mid):
    from pyspark.sql import functions as F

    from wellspring.sources import Tables
    from wellspring.sources import roles as R
    t = Tables(spark, sf_mid)
    q = QUERIES
    assert R.queue_log(t).filter(F.col("time_in_queue") == 0).count() == 178
    docs = R.documents(t)
    assert docs.filter(F.octet_length("text") != F.length("text")).count() == 385
    v = q["verify_clean"](spark, sf_mid).first()
    assert (v.violations_before, v.violations_after) == (202, 0)
    loc = R.location(t)
    assert loc.select("province_name", "town_name").distinct().count() == 25
    assert loc.select("town_name").distinct().count() == 7
    assert R.well_pollution(t).count() == 311


def test_two_forms_give_the_same_numbers(spark, sf_mid):
    q = QUERIES
    by_window = sorted(map(tuple, q["share_window"](spark, sf_mid).collect()))
    by_total = sorted(map(tuple, q["share_crossjoin"](spark, sf_mid).select(
        "location_type", "record_count", "percentage").collect()))
    assert by_window == by_total
    assert q["avg_queue_filter"](spark, sf_mid).first()[0] == q["avg_queue_nullif"](spark, sf_mid).first()[0]
    acc = q["audit_accuracy"](spark, sf_mid).first()
    assert acc.agreeing == q["audit_match_first"](spark, sf_mid).count()
    assert acc.disagreeing == q["audit_mismatch"](spark, sf_mid).count()
    assert acc.agreeing + acc.disagreeing == acc.audited

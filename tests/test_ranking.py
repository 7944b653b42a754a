"""Skew-proof numbering against the plain window (FIXTURES.md: rank_ties)."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.util import plan_text
from wellspring.operators import row_number_within, running_totals, top_n_within
from wellspring.plans import profile
from wellspring.sources import Tables
from wellspring.sources import roles as R


def _window_rn(df, part, order):
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*part).orderBy(*order)))


def _as_set(df):
    return sorted(tuple(r) for r in df.select("id", "rn").collect())


@pytest.mark.parametrize("parts", [1, 3, 8, 50])
def test_matches_window_on_whole_part_table(spark, sf_mid, parts):
    ws = R.water_source(Tables(spark, sf_mid)).withColumnRenamed("source_id", "id")
    order = [F.desc("number_of_people_served"), F.asc("id")]
    got = row_number_within(ws, ["type_of_water_source"], order, num_partitions=parts)
    want = _window_rn(ws, ["type_of_water_source"], order)
    assert _as_set(got) == _as_set(want)


rows = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3)), min_size=0, max_size=40)


@settings(max_examples=12, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_matches_window_on_random_groups_with_ties_and_nulls(spark, data):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(data)], "id long, g string, v int")
    order = [F.desc("v"), F.asc("id")]
    got = row_number_within(df, ["g"], order, num_partitions=4)
    assert _as_set(got) == _as_set(_window_rn(df, ["g"], order))


def test_one_hot_group_is_spread_over_partitions(spark):
    df = spark.range(0, 20000).select(F.col("id"), F.lit("hot").alias("g"), (F.col("id") % 7).alias("v"))
    got = row_number_within(df, ["g"], [F.asc("v"), F.asc("id")], num_partitions=8)
    per_task = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in per_task) < 20000  # not all in one task
    assert got.agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first() == (1, 20000, 20000)


def test_top_n_uses_partial_group_limit(spark, sf_mid):
    ws = R.water_source(Tables(spark, sf_mid))
    top = top_n_within(ws, ["type_of_water_source"], [F.desc("number_of_people_served"), "source_id"], 3)
    assert "WindowGroupLimit" in plan_text(top)
    assert top.count() == 6 * 3


def test_rank_ties_share_rank_then_gap(spark):
    src = spark.createDataFrame([(1, "a", 10), (2, "b", 10), (3, "c", 5)],
                                "source_id long, type_of_water_source string, number_of_people_served int")
    got = {r.type_of_water_source: r.rank_by_people_served for r in profile.rank_types_by_people(src).collect()}
    assert got == {"a": 1, "b": 1, "c": 3}


def test_pick_ranked_ranks_before_filtering(spark):
    src = spark.createDataFrame([(1, "t", 10), (2, "t", 30), (3, "t", 20), (4, "u", 30)],
                                "source_id long, type_of_water_source string, number_of_people_served int")
    got = {r.source_id: r.source_rank for r in profile.pick_ranked(src, [1, 4]).collect()}
    assert got == {1: 3, 4: 1}


def _against_plain_window(spark, n):
    ids = F.col("id")
    df = spark.range(n).select(ids.alias("k"), (ids % 5).alias("g"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v"),
                               F.concat(F.lit("payload "), ids.cast("string")).alias("payload"))
    got = row_number_within(df, ["g"], [F.desc("v"), F.asc("k")])
    plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("v"), F.asc("k"))))
    assert got.columns == plain.columns
    wrong = got.select("k", "payload", "rn").join(plain.select("k", F.col("rn").alias("want")), "k").filter("rn <> want")
    assert wrong.count() == 0 and got.count() == n


def test_row_numbers_with_a_payload_column(spark):
    _against_plain_window(spark, 1_000_000)


def test_row_numbers_without_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        _against_plain_window(spark, 200_000)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_running_totals(spark):
    rows = [("a", i, i % 7) for i in range(500)] + [(None, i, 1) for i in range(50)] + [("b", 0, 5)]
    df = spark.createDataFrame(rows, "g string, k int, v int")
    got = {(r.g, r.k): r.before for r in running_totals(df, ["g"], ["k"], "v", "before").collect()}
    for g in ("a", None, "b"):
        total = 0
        for _, k, v in sorted((r for r in rows if r[0] == g), key=lambda r: r[1]):
            assert got[g, k] == total
            total += v

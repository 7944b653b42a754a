"""A key holding a third of the rows: results stay whole and the hot partition is split."""

import pytest
from pyspark.sql import functions as F

from wellspring.operators import hot_keys, hot_keys_by, not_in, row_number_within, skew_join
from wellspring.plans import access


@pytest.fixture
def shuffle_only(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",          # as with tables too big to broadcast
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _skewed_inputs(spark, n=90_000):
    ids = F.col("id")
    # source 0 takes a third of all visits; the rest spread over 3,000 sources
    visits = spark.range(n).select(
        ids.alias("record_id"), (ids % 5000).alias("location_id"),
        F.when(ids % 3 == 0, F.lit(0)).otherwise(ids % 3000 + 1).alias("source_id"),
        F.lit(1).alias("visit_count"), (ids % 40).cast("int").alias("time_in_queue"))
    sources = spark.range(3001).select(
        F.col("id").alias("source_id"),
        F.element_at(F.array(*[F.lit(t) for t in access.SOURCE_TYPES]),
                     (F.col("id") % 5 + 1).cast("int")).alias("type_of_water_source"),
        (F.col("id") % 50 + 1).cast("int").alias("number_of_people_served"))
    pollution = sources.filter(F.col("type_of_water_source") == "well").select(
        "source_id", F.lit("x").alias("description"), F.lit("Clean").alias("results"),
        F.lit(0.0).alias("biological"))
    location = spark.range(5000).select(
        F.col("id").alias("location_id"), F.lit("a").alias("address"),
        F.concat(F.lit("P"), (F.col("id") % 5).cast("string")).alias("province_name"),
        F.concat(F.lit("T"), (F.col("id") % 7).cast("string")).alias("town_name"),
        F.lit("Rural").alias("location_type"))
    return visits, pollution, location, sources


def test_hot_source_join_is_split_and_whole(shuffle_only):
    spark = shuffle_only
    visits, pollution, location, sources = _skewed_inputs(spark)
    assert list(hot_keys(visits, "source_id")) == [0]
    found = hot_keys_by(visits, ["source_id", "location_id"])
    assert list(found["source_id"]) == [0] and found["location_id"] == {}
    assert 0.2 < found["source_id"][0] < 0.5  # about a third of the rows
    # the join on the hot source: no task holds the third of the rows
    joined = skew_join(visits, sources, "source_id")
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 90_000 and max(sizes) < 90_000 / 4
    plain = visits.join(sources, "source_id")
    plain_sizes = [r["count"] for r in plain.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(plain_sizes) >= 30_000
    # whole results: the salted plan returns exactly the plain join's rows
    cols = sorted(plain.columns)
    assert sorted(map(tuple, joined.select(cols).collect())) == sorted(map(tuple, plain.select(cols).collect()))
    view = access.combined_view(visits, pollution, location, sources)
    assert view.count() == 90_000


def test_left_skew_join_keeps_unmatched_rows(spark):
    fact = spark.createDataFrame([(1, "a")] * 50 + [(2, "b"), (None, "c")], "k long, v string")
    dim = spark.createDataFrame([(2, "two"), (3, "three")], "k long, name string")
    got = skew_join(fact, dim, "k", "left", salts=4, hot=[1])
    want = fact.join(dim, ["k"], "left")
    assert sorted(map(tuple, got.select("k", "v", "name").collect()), key=str) == \
        sorted(map(tuple, want.select("k", "v", "name").collect()), key=str)


def test_hot_group_rank_is_spread(spark):
    df = spark.range(60_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            (F.col("id") % 50).cast("string")).alias("g"), (F.col("id") % 11).alias("v"))
    ranked = row_number_within(df, ["g"], [F.desc("v"), F.asc("id")], num_partitions=16)
    sizes = [r["count"] for r in ranked.filter(F.col("g") == "hot")
             .groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) > 1  # the hot group is numbered by several tasks
    hot = ranked.filter(F.col("g") == "hot").agg(F.min("rn"), F.max("rn"), F.count("*")).first()
    assert tuple(hot) == (1, 20_000, 20_000)


def test_salted_chain_on_real_tables_equals_plain_joins(spark, sf_mid):
    from wellspring.operators import skew_join_chain
    from wellspring.sources import Tables
    from wellspring.sources import roles as R

    t = Tables(spark, sf_mid)
    visits = R.visits(t).filter(F.col("visit_count") == 1).select("source_id", "location_id", "time_in_queue")
    sources, pollution = R.water_source(t), R.well_pollution(t).select("source_id", "results")
    busiest = [r.source_id for r in visits.groupBy("source_id").count()
               .orderBy(F.desc("count"), "source_id").limit(3).collect()]
    wells = [r.source_id for r in pollution.limit(2).collect()]  # hot keys with a pollution row too
    salted = skew_join_chain(visits, "source_id", [(sources, "inner"), (pollution, "left")],
                             salts=8, hot=busiest + wells)
    plain = visits.join(sources, "source_id").join(pollution, "source_id", "left")
    cols = sorted(plain.columns)
    assert sorted(salted.columns) == cols
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(salted.select(cols).collect(), key=key) == sorted(plain.select(cols).collect(), key=key)


def test_salt_counts_scale_with_share_and_partitions(spark):
    from wellspring.operators import salt_counts
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20000")
    try:
        got = salt_counts(spark, {"hot": 1 / 3, "warm": 0.01, "tiny": 0.0001})
        assert got == {"hot": 53334, "warm": 1600, "tiny": 16}  # an eighth of an average partition each
        assert salt_counts(spark, ["a"]) == {"a": 20000}           # share unknown: P
        assert salt_counts(spark, ["a"], salts=3) == {"a": 3}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def _largest_share(df, parts):
    """The largest task's rows as a multiple of the mean over all tasks."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) * parts / sum(sizes)


@pytest.fixture
def sixty_four(shuffle_only):
    shuffle_only.conf.set("spark.sql.adaptive.enabled", "false")
    shuffle_only.conf.set("spark.sql.shuffle.partitions", "64")
    yield shuffle_only
    shuffle_only.conf.unset("spark.sql.adaptive.enabled")


def test_alike_rows_of_a_hot_key_are_split(sixty_four):
    spark, ids = sixty_four, F.col("id")
    fact = spark.range(400_000).select(ids.alias("record_id"),
                                       F.when(ids % 3 == 0, F.lit(0)).otherwise(ids % 20_000 + 1).alias("k"),
                                       (ids % 7).alias("visit_count"))
    dim = spark.range(20_001).select(ids.alias("k"), F.lit("x").alias("place"))
    joined = skew_join(fact, dim, "k", row_key=["record_id"]).select("k", "place", "visit_count")
    assert joined.count() == 400_000
    assert _largest_share(joined, 64) < 2


def test_null_keys_of_a_left_join_are_split(sixty_four):
    spark, ids = sixty_four, F.col("id")
    fact = spark.range(300_000).select(ids.alias("record_id"),
                                       F.when(ids % 3 != 0, ids % 20_000).alias("k"))
    dim = spark.range(20_000).select(ids.alias("k"), F.lit("x").alias("place"))
    joined = skew_join(fact, dim, "k", "left", row_key=["record_id"])
    assert joined.filter("place is null").count() == 100_000
    assert _largest_share(joined, 64) < 2
    listed = spark.range(100).select(ids.alias("k"))
    assert not_in(fact, listed, "k", row_key=["record_id"]).count() == 200_000 - 1000

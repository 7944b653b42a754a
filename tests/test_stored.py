"""Co-partitioned storage, Bloom reduction, heavy hitters and layouts for point lookups."""

import glob
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.util import plan_text, run_metric
from wellspring.operators import (bucketed_join, combine_summaries, drop_bucketed, heavy_keys, heavy_of, key_summary,
                                  layout_for, layout_of, store_dim, store_fact)
from wellspring.operators import heavy as H
from wellspring.plans import access, audit, stored
from wellspring.sources import Tables
from wellspring.sources import roles as R
from wellspring.sources.clustered import lookup, write_clustered


@pytest.fixture
def as_at_scale(spark):
    """Nothing is broadcast and nothing re-planned."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


# --- buckets ---------------------------------------------------------------------------------

def _rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_source_joins_exchange_nothing(as_at_scale, sf_small):
    t = Tables(as_at_scale, sf_small)
    kept = stored.store_by_source(R.visits(t), R.water_source(t), R.well_pollution(t))
    text = plan_text(stored.combined_view(kept, R.location(t)), "simple")
    assert not re.search(r"hashpartitioning\(source_id", text)
    assert len(re.findall(r"hashpartitioning\(location_id", text)) == 2  # the joined visits and the sites, once
    kept.drop()


def test_record_join_exchanges_nothing(as_at_scale, sf_small):
    t = Tables(as_at_scale, sf_small)
    kept = stored.store_by_record(R.visits(t), R.water_quality(t).select("record_id", "subjective_quality_score"))
    pairs = stored.audit_pairs(kept, R.auditor_report(t))
    assert not re.search(r"hashpartitioning\(record_id", plan_text(pairs, "simple"))
    want = audit.audit_pairs(R.auditor_report(t), R.visits(t), R.water_quality(t))
    cols = ["location_id", "record_id", "auditor_score", "surveyor_score"]
    assert _rows(pairs, cols) == _rows(want, cols)
    kept.drop()


def test_a_third_on_one_key_is_cut_and_whole(as_at_scale):
    spark = as_at_scale
    fact = spark.range(60_000).select(F.col("id").alias("rid"), F.when(F.col("id") % 3 == 0, F.lit(5)).when(
        F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 900).alias("k"))
    dim = spark.range(0, 900, 2).select(F.col("id").alias("k"), F.concat(F.lit("d"), "id").alias("name"))
    dim = dim.union(spark.createDataFrame([(None, "none"), (5, "five")], "k long, name string"))
    layout = layout_for(fact, "k", buckets=16)
    assert set(layout.pieces) == {5, None}
    a, b = store_fact(fact, "fact", layout, ["rid"]), store_dim(dim, "dim", layout)
    assert layout_of(spark, a) == layout
    sizes = [r["count"] for r in spark.table(a).groupBy(F.pmod(F.hash("k", "_ws_salt"), F.lit(16))).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 60_000 / 16
    for how in ("inner", "left"):
        joined = bucketed_join(spark, a, [(b, how)])
        assert "Exchange" not in plan_text(joined, "simple")
        assert _rows(joined, ["rid", "k", "name"]) == _rows(fact.join(dim, "k", how), ["rid", "k", "name"])
    drop_bucketed(spark, a, b)
    assert not spark.catalog.tableExists(a)


def test_layout_needs_a_stored_table(spark):
    t = layout_for(spark.createDataFrame([("it's", 1)], "k string, v int"), "k", 2, hot={"it's": 0.5, None: 0.1})
    name = store_fact(spark.createDataFrame([("it's", 1), (None, 2)], "k string, v int"), "quoted", t)
    assert layout_of(spark, name) == t
    assert spark.table(name).count() == 2
    drop_bucketed(spark, name)
    spark.sql("create table ws_plain_test (k int) using parquet")
    with pytest.raises(ValueError):
        layout_of(spark, "ws_plain_test")
    spark.sql("drop table ws_plain_test")


def test_empty_tables(spark):
    none = spark.createDataFrame([], "k long, v int")
    layout = layout_for(none, "k", 4)
    a, b = store_fact(none, "none", layout), store_dim(none.select("k", F.lit("x").alias("name")), "none_dim", layout)
    assert layout.pieces == {} and bucketed_join(spark, a, [(b, "left")]).count() == 0
    drop_bucketed(spark, a, b)


# --- Bloom filters ------------------------------------------------------------------------------

def test_scores_are_reduced_before_their_shuffle(as_at_scale, tmp_path):
    """A survey's own quality table, which nothing restricts: only scores of records that first visits can hold
    are shuffled."""
    spark = as_at_scale
    n, first = 200_000, 2_000
    visits = spark.range(n).select(
        F.col("id").alias("record_id"), (F.col("id") % 5000).alias("location_id"), F.lit(1).alias("assigned_employee_id"),
        F.lit(1).alias("source_id"), F.when(F.col("id") % (n // first) == 0, 1).otherwise(2).alias("visit_count"))
    quality = spark.range(n).select(F.col("id").alias("record_id"), (F.col("id") % 10).alias("subjective_quality_score"))
    auditor = spark.range(5000).select(F.col("id").alias("location_id"), F.lit("well").alias("type_of_water_source"),
                                       F.lit(3).cast("long").alias("true_water_source_score"), F.lit("x").alias("statements"))
    for name, df in (("visits", visits), ("quality", quality), ("auditor", auditor)):
        df.write.parquet(str(tmp_path / name))
    visits, quality, auditor = (spark.read.parquet(str(tmp_path / x)) for x in ("visits", "quality", "auditor"))
    size = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    plain = audit.audit_pairs(auditor, visits, quality)
    shuffled = run_metric(plain, "Exchange", "shuffleRecordsWritten")
    assert n in shuffled  # the test's tables are below the size from which Spark bothers
    spark.conf.set(size, "0")
    try:
        reduced = audit.audit_pairs(auditor, visits, quality)
        assert "might_contain" in plan_text(reduced, "simple") and "bloom_filter_agg" in plan_text(reduced, "simple")
        shuffled = run_metric(reduced, "Exchange", "shuffleRecordsWritten")
        assert max(x for x in shuffled) <= 5000 and sorted(shuffled)[-2] < 1.1 * first + 5000
        assert _rows(reduced, ["record_id"]) == [(i,) for i in sorted(range(0, n, n // first), key=lambda i: str((i,)))]
    finally:
        spark.conf.unset(size)


def test_registered_audit_has_bloom_filters(as_at_scale, sf_small):
    size = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    from wellspring.plans.registry import QUERIES
    as_at_scale.conf.set(size, "0")
    try:
        for key in ("audit_source_compare", "audit_by_employee", "audit_mismatch"):
            assert "might_contain" in plan_text(QUERIES[key](as_at_scale, sf_small), "simple"), key
    finally:
        as_at_scale.conf.unset(size)


def test_first_visits_reach_both_scans(as_at_scale, sf_small):
    from wellspring.plans.registry import QUERIES
    for key in ("audit_mismatch", "audit_match_first", "audit_accuracy", "distinct_offenders"):
        text = plan_text(QUERIES[key](as_at_scale, sf_small))
        assert text.count("EqualTo(l_linenumber,1)") >= 2, key
    assert "EqualTo(l_linenumber,2)" in plan_text(QUERIES["filter_and"](as_at_scale, sf_small))


# --- heavy hitters -----------------------------------------------------------------------------

@pytest.mark.parametrize("parts", [1, 7, 64])
def test_a_key_of_one_percent_is_always_found(spark, parts):
    n = 400_000  # far more different values than are tracked, the heavy one's rows in one place or spread
    together = F.when(F.col("id") < n // 100, F.lit(-1)).otherwise(F.col("id"))
    spread = F.when(F.col("id") % 100 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    df = spark.range(0, n, 1, parts).select(together.alias("a"), spread.alias("b"))
    found = heavy_keys(df, ["a", "b"], min_share=0.01)
    assert -1 in found["a"] and "hot" in found["b"]
    assert all(0.01 <= s <= 0.01 + H.error_share() for c in found.values() for s in c.values())


def test_summaries_combine(spark):
    df = spark.range(100_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 5 == 0, F.lit(None))
                                     .otherwise(F.col("id")).alias("k"))
    parts = [key_summary(df.sample(0.3, seed=s), ["k"]) for s in (1, 2, 3)]
    whole = combine_summaries(parts[0].union(parts[1]).union(parts[2]))
    found = heavy_of(whole, ["k"])["k"]
    assert set(found) == {7, None} and abs(found[7] - 1 / 3) < 0.02
    assert heavy_of(key_summary(df.filter("false"), ["k"]), ["k"]) == {"k": {}}
    with pytest.raises(ValueError):
        heavy_of(whole, ["k"], min_share=0.0001)


def test_one_scan_for_a_table_and_application(spark, sf_small, monkeypatch):
    calls = []
    monkeypatch.setattr(H, "key_summary", lambda *a, f=H.key_summary: calls.append(1) or f(*a))
    H._remembered.clear()
    for _ in range(3):  # each time the table is opened anew
        t = Tables(spark, sf_small)
        access.combined_view(R.visits(t), R.well_pollution(t), R.location(t, hot={}), R.water_source(t))
    assert len(calls) == 1


# --- point lookups ----------------------------------------------------------------------------

def test_a_lookup_reads_two_row_groups_at_most(as_at_scale, tmp_path):
    spark, path = as_at_scale, str(tmp_path / "clustered")
    rows = spark.range(400_000).select((F.xxhash64("id") % 1_000_000).alias("key"), "id", F.sha2(F.col("id").cast(
        "string"), 256).alias("text"))
    write_clustered(rows, path, "key", files=4, row_group_bytes=200_000)
    groups = [pq.ParquetFile(f).metadata for f in glob.glob(path + "/*.parquet")]
    n = sum(m.num_row_groups for m in groups)
    largest = max(m.row_group(i).num_rows for m in groups for i in range(m.num_row_groups))
    assert n >= 100 and all(m.row_group(0).column(0).statistics.has_min_max for m in groups)
    have = [r[0] for r in rows.select("key").limit(20).collect()]
    for key in have[:5]:
        found = lookup(spark, path, "key", [key])
        assert found.count() == rows.filter(F.col("key") == key).count() >= 1
        assert max(run_metric(lookup(spark, path, "key", [key]), "Scan", "numOutputRows")) <= 2 * largest
    known = {r[0] for r in rows.select("key").collect()}
    missing = [k for k in range(1, 2000) if k not in known][:5]
    read = [sum(run_metric(lookup(spark, path, "key", [k]), "Scan", "numOutputRows")) for k in missing]
    assert sum(r == 0 for r in read) >= 4  # the Bloom filter rules them out, though their row group's range has them
    assert lookup(spark, path, "key", have).count() == rows.filter(F.col("key").isin(have)).count()

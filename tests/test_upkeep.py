"""Stored results kept up to date, corrections in place, publishing from two drivers, ranks from counts, collation."""

import glob
import os
import threading

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.util import plan_text
from wellspring.functions import case_blind, plain
from wellspring.operators import append_batch, publish_folder
from wellspring.plans import access, clean, profile, upkeep, workorders
from wellspring.sources import Tables
from wellspring.sources import roles as R


# --- refresh -----------------------------------------------------------------------------------

VIEW = "source_type string, town_name string, province_name string, people_served int"


def test_refresh_reads_only_the_new_batch(spark, tmp_path):
    sums, rows = str(tmp_path / "sums"), [
        ("river", "T1", "P1", 30), ("well", "T1", "P1", 10), ("well", "T1", "P2", 5), ("other", "T2", None, 7),
        ("well", "T2", None, None), ("shared_tap", "T1", "P1", 60)]
    folders = []
    for i, part in enumerate((rows[:2], rows[2:5], rows[5:])):
        path = str(tmp_path / f"batch{i}")
        spark.createDataFrame(part, VIEW).write.parquet(path)
        folders.append(path)
        view = spark.read.parquet(path)
        upkeep.add_batch(view, sums, f"b{i}")
        assert all(path + "/" in f for f in upkeep.people_sums(view).inputFiles())
        so_far = spark.createDataFrame([r for p in (rows[:2], rows[2:5], rows[5:])[:i + 1] for r in p], VIEW)
        got = sorted(map(tuple, upkeep.stored_shares(spark, sums).collect()), key=str)
        assert got == sorted(map(tuple, access.source_share(so_far, upkeep.PLACE).collect()), key=str)
        for f in glob.glob(path + "/*.parquet"):
            os.remove(f)  # a later refresh can't read an earlier batch
    upkeep.compact(spark, sums, str(tmp_path / "merged"))
    assert sorted(map(tuple, upkeep.stored_shares(spark, str(tmp_path / "merged")).collect()), key=str) == got


def test_the_same_batch_counts_once(spark, tmp_path):
    view = spark.createDataFrame([("river", "T", "P", 3)], VIEW)
    for _ in range(2):
        upkeep.add_batch(view, str(tmp_path / "s"), "b")
    assert upkeep.stored_shares(spark, str(tmp_path / "s")).first().river == 100
    assert spark.read.parquet(str(tmp_path / "s/kind=people")).count() == 1


# --- corrections in place ------------------------------------------------------------------------

def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(path + "/part=*/*.parquet")}


def test_other_partitions_keep_their_files(spark, sf_mid, tmp_path):
    path, pollution = str(tmp_path / "pollution"), R.well_pollution(Tables(spark, sf_mid))
    # partitions 3, 7, ... hold descriptions that no rule touches, and clean results only below the limit
    table = pollution.withColumn("part", F.pmod("source_id", F.lit(40)))
    upkeep.store_partitioned(table, path, "part")
    before = _files(path)
    changed = upkeep.correct_partial(spark, path, clean.corrections(), "part")
    after = _files(path)
    want = clean.correct(table)
    old = table.withColumnRenamed("description", "d").withColumnRenamed("results", "r").select("source_id", "d", "r")
    differs = want.join(old, "source_id").filter("d <> description or r <> results").select("part").distinct()
    assert changed == sorted(r[0] for r in differs.collect()) and 0 < len(changed) < 40
    kept = {f for f in before if int(f.split("part=")[1].split("/")[0]) not in changed}
    assert kept and all(after[f] == before[f] for f in kept) and not (set(before) - kept) & set(after)
    cols = sorted(table.columns)
    assert sorted(map(tuple, spark.read.parquet(path).select(cols).collect())) == \
        sorted(map(tuple, want.select(cols).collect()))
    assert upkeep.correct_partial(spark, path, clean.corrections(), "part") == []  # nothing is left to do
    assert _files(path) == after


def test_chained_rules_and_null_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", None), (2, "b", "p"), (3, "c", "q"), (4, None, "q")], "id int, v string, part string")
    upkeep.store_partitioned(df, path, "part")
    rules = [("v", F.lit("b"), F.col("v") == "a"), ("v", F.lit("c"), F.col("v") == "b")]  # the second follows the first
    assert upkeep.correct_partial(spark, path, rules, "part") == [None, "p"]
    assert sorted((r.id, r.v, r.part) for r in spark.read.parquet(path).collect()) == [
        (1, "c", None), (2, "c", "p"), (3, "c", "q"), (4, None, "q")]
    with pytest.raises(ValueError):
        upkeep.correct_partial(spark, path, [("part", F.lit("z"), F.lit(True))], "part")


# --- publishing ------------------------------------------------------------------------------------

def test_two_drivers_publish_a_batch_once(spark, tmp_path):
    path, won = str(tmp_path / "orders"), []
    df = spark.range(1000)
    ready = threading.Barrier(4)

    def driver():
        ready.wait()
        won.append(append_batch(df, path, "run_date", "2024-05-01", "b"))

    threads = [threading.Thread(target=driver) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(won) == [False, False, False, True]
    assert spark.read.parquet(path).count() == 1000
    assert not [f for f in glob.glob(path + "/_attempts/*")]


def test_a_rename_that_comes_second_loses(spark, tmp_path):
    for name in ("one", "two"):
        spark.range(5).write.parquet(str(tmp_path / name))
    assert publish_folder(spark, str(tmp_path / "one"), str(tmp_path / "t/batch=1"))
    assert not publish_folder(spark, str(tmp_path / "two"), str(tmp_path / "t/batch=1"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5 and not (tmp_path / "two").exists()
    with pytest.raises(Exception):  # noqa: B017 - not there at all
        publish_folder(spark, str(tmp_path / "nothing"), str(tmp_path / "t/batch=2"))


# --- ranks from counts ----------------------------------------------------------------------------------

def test_ranks_of_a_million_sources_with_ties(spark):
    n = 1_000_000
    src = spark.range(n).select(
        F.col("id").alias("source_id"), F.when(F.col("id") % 3 == 0, F.lit("well")).when(F.col("id") % 1000 == 1, F.lit(
            None)).otherwise("river").alias("type_of_water_source"),
        F.when(F.col("id") % 11 == 5, F.lit(None)).otherwise(F.col("id") % 50).cast("int").alias("number_of_people_served"))
    picks = [0, 3, 5, 17, 499_999, 500_001, 999_999, 777_777, 1001, 2_000_000]
    w = Window.partitionBy("type_of_water_source").orderBy(F.desc("number_of_people_served"), F.asc("source_id"))
    want = src.withColumn("r", F.row_number().over(w)).filter(F.col("source_id").isin(picks))
    got = profile.pick_ranked(src, picks)
    assert sorted((r.source_id, r.source_rank) for r in got.collect()) == sorted((r.source_id, r.r) for r in want.collect())
    assert got.columns == [*src.columns, "source_rank"]


def test_ranking_stores_only_counts(spark, sf_mid, monkeypatch):
    from wellspring.operators import ranking
    stored = []
    monkeypatch.setattr(profile.running_totals, "__defaults__", tuple(
        (lambda df, name, f=d: stored.append(df.count()) or f(df, name)) if callable(d) else d
        for d in ranking.running_totals.__defaults__))
    src = R.water_source(Tables(spark, sf_mid))
    assert profile.pick_ranked(src, [3, 58, 101]).count() == 3
    # 6 types, 50 sizes and 7 cells at most, whatever the number of sources
    assert stored and max(stored) <= 6 * 50 * 7 and max(stored) < src.count()


def test_repeated_and_null_ids_and_many_picks(spark):
    rows = [(1, "a", 5), (1, "a", 5), (None, "a", 5), (2, "a", 5), (3, "a", 9), (4, None, None)]
    src = spark.createDataFrame(rows, "source_id long, type_of_water_source string, number_of_people_served int")
    got = sorted((r.source_id, r.source_rank) for r in profile.pick_ranked(src, [1, 2, 4]).collect())
    assert got == [(1, 3), (1, 4), (2, 5), (4, 1)]
    many = profile.pick_ranked(src, list(range(1, 100)))
    assert sorted((r.source_id, r.source_rank) for r in many.collect()) == sorted([*got, (3, 1)])
    assert profile.pick_ranked(src, []).count() == 0


# --- roll-up and collation -------------------------------------------------------------------------------

def test_rollup_expands_towns_not_orders(spark, sf_mid):
    orders = spark.read.parquet(sf_mid + "/orders.parquet").select(
        F.lit("P").alias("province_name"), F.col("o_orderstatus").alias("town_name"), F.lit(None).cast("string").alias(
            "Source_status"))
    text = plan_text(workorders.progress_rollup(orders), "simple")
    lines = [x.strip(" :+-*0123456789()") for x in text.splitlines()]
    assert "HashAggregate" in lines[next(i for i, x in enumerate(lines) if x.startswith("Expand")) + 1]
    got = {(r.province_name, r.town_name, r.level): r.work_orders for r in workorders.progress_rollup(orders).collect()}
    want = {(r.province_name, r.town_name, r.level): r["n"] for r in orders.rollup("province_name", "town_name").agg(
        F.count("*").alias("n"), F.grouping_id().alias("level")).collect()}
    assert got == want


def test_case_blind_comparison(spark):
    df = spark.createDataFrame([("Clean_x",), ("CLEAN",), ("clean y",), (None,), ("Straße",), ("ÉTÉ",)], "s string")
    s = case_blind("s")
    assert df.filter(s == "clean").count() == 1
    assert df.filter(s.isin("CLEAN", "été")).count() == 2
    assert df.filter(s.like("cLEAN_%")).count() == 2
    assert df.groupBy(F.lower("s")).count().count() == df.groupBy(s.alias("k")).count().count()
    other = spark.createDataFrame([("cLeAn",), (None,)], "t string")
    assert [r.s for r in df.join(other, s == case_blind("t")).collect()] == ["CLEAN"]
    assert df.filter(plain(s) == "clean").count() == 0

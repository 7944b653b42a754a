"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each key proves one or more operators of the survey's inventory on the
driver's tables through the role mapping in ``wellspring.sources.roles``.
Every query reads whole tables; literal id lists and the point lookup are
the operators themselves (an ``IN`` list, a one-site check), not samples.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.functions import byte_length, case_blind, plain
from wellspring.operators import hot_keys_by, preview, skew_join, snapshot
from wellspring.operators.scans import fresh_path
from wellspring.plans import access, audit, clean, profile, queues, stored, upkeep, workorders
from wellspring.session import table_path
from wellspring.sources import Tables
from wellspring.sources import roles as R
from wellspring.sources.clustered import lookup, write_clustered

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered queries (the role data has queues of 1-50
# minutes and statements that are order priorities).
LONG_QUEUE_MINUTES = 49
PICKED_SOURCES = [7, 42, 99, 123, 150]
RANKED_PICKS = [3, 58, 101, 144, 199]
LOOKUP_LOCATION = 42
TOP_N = 10
STATEMENT_KEYWORD = "urgent"
BATCH_ENDS = "1996-01-01"  # visits from this day on are a batch of their own
PARTITIONS = 16  # of the pollution table that is corrected in place


def register(key: str):
    def wrap(fn: Query) -> Query:
        QUERIES[key] = fn
        return fn
    return wrap


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def _run_table(spark: SparkSession, name: str, sf_dir: str) -> str:
    """A table folder per application and input folder, in the shared folder."""
    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:12]
    return table_path(spark, name, spark.sparkContext.applicationId, tag)


# --- A: scans, sources, sinks ------------------------------------------------

@register("scan_full")
def scan_full(spark, d):
    return R.visits(_t(spark, d))


@register("project_cols")
def project_cols(spark, d):
    return R.auditor_report(_t(spark, d)).select("location_id", "true_water_source_score")


@register("preview_limit")
def preview_limit(spark, d):
    """The first five locations by id: a top-k per task, then a merge of those."""
    return preview(R.location(_t(spark, d)), 5, order_by=["location_id"])


@register("snapshot_copy")
def snapshot_copy(spark, d):
    return snapshot(R.well_pollution(_t(spark, d)), "well_pollution_copy")


@register("correct_rows")
def correct_rows(spark, d):
    return clean.correct(R.well_pollution(_t(spark, d)))


@register("verify_clean")
def verify_clean(spark, d):
    return clean.verification(R.well_pollution(_t(spark, d)))


@register("email_expr")
def email_expr(spark, d):
    return clean.email_preview(R.staff_names(_t(spark, d)))


@register("fill_email")
def fill_email(spark, d):
    return snapshot(clean.with_email(R.staff_names(_t(spark, d))), "employee_with_email")


@register("phone_length")
def phone_length(spark, d):
    docs = R.documents(_t(spark, d))
    return docs.select("doc_id", byte_length(F.col("text")).alias("length_bytes"))


# --- B/C: projections and filters ---------------------------------------------

@register("distinct_types")
def distinct_types(spark, d):
    return R.water_source(_t(spark, d)).select("type_of_water_source").distinct()


@register("filter_gt")
def filter_gt(spark, d):
    return R.visits(_t(spark, d)).filter(F.col("time_in_queue") > LONG_QUEUE_MINUTES)


@register("filter_in")
def filter_in(spark, d):
    return R.water_source(_t(spark, d)).filter(F.col("source_id").isin(PICKED_SOURCES))


@register("filter_and")
def filter_and(spark, d):
    q = R.water_quality(_t(spark, d))
    return (q.filter((F.col("subjective_quality_score") == "F") & (F.col("visit_count") == 2))
            .select("record_id", "subjective_quality_score", "visit_count"))


@register("filter_contradiction")
def filter_contradiction(spark, d):
    return clean.contradictions(R.well_pollution(_t(spark, d)))


@register("filter_like_prefix")
def filter_like_prefix(spark, d):
    return clean.mislabelled(R.well_pollution(_t(spark, d)))


# --- D/E/F: profile, shares, ranks ---------------------------------------------

@register("count_by_key")
def count_by_key(spark, d):
    emp = R.employee(_t(spark, d))
    return profile.count_by(emp, ["town_name"], "num_employees").orderBy(F.desc("num_employees"))


@register("count_by_town")
def count_by_town(spark, d):
    loc = R.located_customers(_t(spark, d))
    return profile.count_by(loc, ["town_name"], weight="sites").orderBy("town_name")


@register("count_by_location_type")
def count_by_location_type(spark, d):
    loc = R.located_customers(_t(spark, d))
    return profile.count_by(loc, ["location_type"], weight="sites").orderBy(F.desc("record_count"))


@register("count_by_type")
def count_by_type(spark, d):
    ws = R.water_source(_t(spark, d))
    return profile.count_by(ws, ["type_of_water_source"], "count")


@register("count_by_two")
def count_by_two(spark, d):
    loc = R.located_customers(_t(spark, d))
    return (profile.count_by(loc, ["province_name", "town_name"], "records_per_town", "sites")
            .orderBy(F.asc("province_name"), F.desc("records_per_town")))


@register("top_visitors")
def top_visitors(spark, d):
    return profile.top_counts(R.visits(_t(spark, d)), "assigned_employee_id", "visit_count", 3,
                              "number_of_visits")


@register("total_served")
def total_served(spark, d):
    return profile.total_people(R.water_source(_t(spark, d)))


@register("served_by_type")
def served_by_type(spark, d):
    return profile.people_by_type(R.water_source(_t(spark, d))).orderBy(F.desc("total_people_served"))


@register("avg_by_type")
def avg_by_type(spark, d):
    return profile.mean_people_by_type(R.water_source(_t(spark, d)))


@register("rank_types")
def rank_types(spark, d):
    return profile.rank_types_by_people(R.water_source(_t(spark, d))).orderBy(F.desc("total_people_served"))


@register("share_window")
def share_window(spark, d):
    return profile.share_window(R.located_customers(_t(spark, d)), "location_type", weight="sites").orderBy(F.desc("record_count"))


@register("share_crossjoin")
def share_crossjoin(spark, d):
    return (profile.share_of_summed_counts(R.located_customers(_t(spark, d)), "location_type", weight="sites")
            .orderBy(F.desc("record_count")))


@register("share_subquery")
def share_subquery(spark, d):
    return profile.people_share_by_type(R.water_source(_t(spark, d))).orderBy(F.desc("total_people_served"))


@register("rank_then_filter")
def rank_then_filter(spark, d):
    return profile.pick_ranked(R.water_source(_t(spark, d)), RANKED_PICKS)


@register("priority_ranks")
def priority_ranks(spark, d):
    t = _t(spark, d)
    brands = t.part.select(F.col("p_partkey").alias("source_id"), F.col("p_brand").alias("brand"))
    return profile.ranked_sources(R.water_source(t).join(brands, "source_id"))


@register("top_n_per_type")
def top_n_per_type(spark, d):
    return profile.top_sources_per_type(R.water_source(_t(spark, d)), TOP_N)


# --- W5: queues ------------------------------------------------------------------

@register("survey_span")
def survey_span(spark, d):
    return queues.survey_span(R.queue_log(_t(spark, d)))


@register("avg_queue_filter")
def avg_queue_filter(spark, d):
    return queues.mean_queue_filtered(R.queue_log(_t(spark, d)))


@register("avg_queue_nullif")
def avg_queue_nullif(spark, d):
    return queues.mean_queue_nullif(R.queue_log(_t(spark, d)))


@register("queue_by_weekday")
def queue_by_weekday(spark, d):
    return queues.queue_by_weekday(R.queue_log(_t(spark, d)))


@register("queue_by_hour")
def queue_by_hour(spark, d):
    return queues.queue_by_hour(R.queue_log(_t(spark, d)))


@register("queue_by_hour_label")
def queue_by_hour_label(spark, d):
    return queues.queue_by_hour_label(R.queue_log(_t(spark, d)))


@register("queue_heatmap")
def queue_heatmap(spark, d):
    return queues.queue_heatmap(R.queue_log(_t(spark, d)))


# --- J: joins --------------------------------------------------------------------

def _visits_located(t: Tables, hot: dict | list | None = None, location: DataFrame | None = None) -> DataFrame:
    v = R.visits(t).select("record_id", "location_id", "source_id", "visit_count")
    loc = (R.location(t) if location is None else location).select("location_id", "province_name", "town_name")
    return skew_join(v, loc, "location_id", hot=hot, row_key=["record_id"])


@register("join_two")
def join_two(spark, d):
    return _visits_located(_t(spark, d)).select("province_name", "town_name", "visit_count", "location_id")


def _visits_located_sourced(t: Tables, hot: dict | None = None) -> DataFrame:
    ws = R.water_source(t)
    location = R.location(t, hot=(hot or {}).get("o_custkey"))
    hot = hot or hot_keys_by(R.visits(t), ["location_id", "source_id"])
    return (skew_join(_visits_located(t, hot["location_id"], location), ws, "source_id",
                      hot=hot["source_id"], row_key=["record_id"])
            .select("province_name", "town_name", "visit_count", "location_id",
                    "type_of_water_source", "number_of_people_served"))


@register("join_three")
def join_three(spark, d):
    t = _t(spark, d)
    return _visits_located_sourced(t).filter(F.col("visit_count") == 1)


@register("join_point_lookup")
def join_point_lookup(spark, d):
    """One site's visits: the filter stands above the joins, and Catalyst takes it to the scans
    of both sides of the site join, so hardly a row is left to join and hot keys don't matter."""
    t = _t(spark, d)
    return _visits_located_sourced(t, {"location_id": {}, "source_id": {}, "o_custkey": {}}).filter(
        F.col("location_id") == LOOKUP_LOCATION)


# --- W6/W7: audit ------------------------------------------------------------------

def _pairs(t: Tables, first_visit_only: bool = True) -> DataFrame:
    return audit.audit_pairs(R.auditor_report(t), R.visits(t), R.water_quality(t), first_visit_only=first_visit_only)


@register("audit_match")
def audit_match(spark, d):
    return (audit.agreeing(_pairs(_t(spark, d), first_visit_only=False))
            .select("location_id", "record_id", "auditor_score", "surveyor_score"))


@register("audit_match_first")
def audit_match_first(spark, d):
    return (audit.agreeing(_pairs(_t(spark, d)))
            .select("location_id", "record_id", "auditor_score", "surveyor_score"))


@register("audit_mismatch")
def audit_mismatch(spark, d):
    return (audit.disagreeing(_pairs(_t(spark, d)))
            .select("location_id", "auditor_source", "record_id", "auditor_score", "surveyor_score"))


@register("audit_accuracy")
def audit_accuracy(spark, d):
    return audit.accuracy(_pairs(_t(spark, d)))


@register("audit_source_compare")
def audit_source_compare(spark, d):
    t = _t(spark, d)
    hot = hot_keys_by(R.visits(t).filter(F.col("visit_count") == 1), ["location_id", "source_id"])
    pairs = audit.audit_pairs(R.auditor_report(t), R.visits(t), R.water_quality(t), hot_sites=hot["location_id"])
    wrong = audit.with_survey_source(audit.disagreeing(pairs), R.water_source(t), hot=hot["source_id"])
    return wrong.select("location_id", "auditor_source", "survey_source", "record_id",
                        "auditor_score", "surveyor_score")


@register("audit_by_employee")
def audit_by_employee(spark, d):
    t = _t(spark, d)
    hot = hot_keys_by(R.visits(t).filter(F.col("visit_count") == 1), ["location_id", "assigned_employee_id"])
    pairs = audit.audit_pairs(R.auditor_report(t), R.visits(t), R.water_quality(t), hot_sites=hot["location_id"])
    wrong = audit.with_employee(audit.disagreeing(pairs), R.employee(t), hot=hot["assigned_employee_id"])
    return wrong.select("location_id", "record_id", "employee_name", "auditor_score", "surveyor_score")


@register("incorrect_view")
def incorrect_view(spark, d):
    t = _t(spark, d)
    return (audit.incorrect_records(R.auditor_report(t), R.visits(t), R.employee(t), R.water_quality(t))
            .select("location_id", "record_id", "employee_name", "auditor_score", "surveyor_score",
                    "statements"))


@register("distinct_offenders")
def distinct_offenders(spark, d):
    t = _t(spark, d)
    return audit.offenders(R.auditor_report(t), R.visits(t), R.employee(t), R.water_quality(t))


def _mistakes(t: Tables) -> DataFrame:
    return audit.mistakes_per_employee(R.auditor_report(t), R.visits(t), R.employee(t), R.water_quality(t))


@register("mistakes_per_employee")
def mistakes_per_employee(spark, d):
    return _mistakes(_t(spark, d)).orderBy(F.desc("number_of_mistakes"))


@register("avg_mistakes")
def avg_mistakes(spark, d):
    return audit.mean_mistakes(_mistakes(_t(spark, d)))


@register("suspect_list")
def suspect_list(spark, d):
    return audit.suspects(_mistakes(_t(spark, d)))


@register("suspect_statements")
def suspect_statements(spark, d):
    t = _t(spark, d)
    return audit.suspect_evidence(R.auditor_report(t), R.visits(t), R.employee(t), STATEMENT_KEYWORD,
                                  R.water_quality(t))


@register("nonsuspect_statements")
def nonsuspect_statements(spark, d):
    t = _t(spark, d)
    return audit.suspect_evidence(R.auditor_report(t), R.visits(t), R.employee(t), STATEMENT_KEYWORD,
                                  R.water_quality(t), suspected=False)


# --- W8/W9: access ------------------------------------------------------------------

def _combined(t: Tables) -> DataFrame:
    return access.combined_view(R.visits(t), R.well_pollution(t), R.location(t), R.water_source(t))


@register("combined_view")
def combined_view(spark, d):
    return _combined(_t(spark, d))


@register("province_source_share")
def province_source_share(spark, d):
    return access.province_share(_combined(_t(spark, d)))


@register("town_source_share")
def town_source_share(spark, d):
    return access.town_share(_combined(_t(spark, d)))


@register("town_access_mat")
def town_access_mat(spark, d):
    return access.town_access_table(_combined(_t(spark, d)))


@register("ratio_broken")
def ratio_broken(spark, d):
    return access.broken_tap_ratio(access.town_access_table(_combined(_t(spark, d))))


@register("ratio_broken_exact")
def ratio_broken_exact(spark, d):
    return access.broken_tap_ratio_exact(_combined(_t(spark, d)))


@register("headline_shares")
def headline_shares(spark, d):
    return access.headline_shares(_combined(_t(spark, d)))


# --- W10/W11: work orders -------------------------------------------------------------

def _orders(t: Tables) -> DataFrame:
    return workorders.work_orders(R.water_source(t), R.well_pollution(t), R.visits(t), R.location(t),
                                  run_date=workorders.REGISTERED_RUN_DATE)


def _published(spark: SparkSession, d: str) -> DataFrame:
    t = _t(spark, d)
    return workorders.publish_work_orders(_orders(t), R.water_source(t), workorders.REGISTERED_RUN_DATE,
                                          path=_run_table(spark, "project_progress", d))


@register("work_orders")
def work_orders(spark, d):
    return _published(spark, d)


@register("work_orders_cleaned")
def work_orders_cleaned(spark, d):
    t = _t(spark, d)
    return workorders.work_orders(R.water_source(t), R.well_pollution(t), R.visits(t), R.location(t),
                                  run_date=workorders.REGISTERED_RUN_DATE, cleaned=True)


@register("work_orders_violations")
def work_orders_violations(spark, d):
    t = _t(spark, d)
    return workorders.violations(_orders(t), R.water_source(t))


@register("progress_rollup")
def progress_rollup(spark, d):
    return workorders.progress_rollup(_published(spark, d))


# --- co-partitioned storage, upkeep, layout ------------------------------------------------

@register("combined_view_bucketed")
def combined_view_bucketed(spark, d):
    t = _t(spark, d)
    kept = stored.store_by_source(R.visits(t), R.water_source(t), R.well_pollution(t))
    return stored.combined_view(kept, R.location(t))


@register("audit_match_bucketed")
def audit_match_bucketed(spark, d):
    t = _t(spark, d)
    kept = stored.store_by_record(R.visits(t), R.water_quality(t).select("record_id", "subjective_quality_score"))
    pairs = stored.audit_pairs(kept, R.auditor_report(t))
    return audit.agreeing(pairs).select("location_id", "record_id", "auditor_score", "surveyor_score")


@register("town_access_refresh")
def town_access_refresh(spark, d):
    """Two batches of visits, added one after the other; each is read once and only its sums are kept."""
    t = _t(spark, d)
    path = fresh_path(t.region, "town_access_sums", temporary=True)
    later = F.col("time_of_record") >= F.lit(BATCH_ENDS).cast("timestamp_ntz")
    for batch, own in (("before", ~later | F.col("time_of_record").isNull()), ("after", later)):
        view = access.combined_view(R.visits(t).filter(own), R.well_pollution(t), R.location(t), R.water_source(t))
        upkeep.add_batch(view, path, batch)
    return upkeep.stored_shares(spark, path)


@register("correct_rows_partial")
def correct_rows_partial(spark, d):
    pollution = R.well_pollution(_t(spark, d))
    path = fresh_path(pollution, "well_pollution", temporary=True)
    upkeep.store_partitioned(pollution.withColumn("part", F.pmod("source_id", F.lit(PARTITIONS))), path, "part")
    upkeep.correct_partial(spark, path, clean.corrections(), "part")
    return spark.read.parquet(path).select(*pollution.columns)


@register("lookup_clustered")
def lookup_clustered(spark, d):
    visits = R.visits(_t(spark, d))
    path = fresh_path(visits, "visits_by_site", temporary=True)
    write_clustered(visits, path, "location_id")
    return lookup(spark, path, "location_id", [LOOKUP_LOCATION])


# --- comparison without regard to case, as in the survey's server ---------------------------------

@register("filter_case_blind")
def filter_case_blind(spark, d):
    said = case_blind("statements")
    rows = R.auditor_report(_t(spark, d)).filter(
        (said == "1-urgent") | said.isin("2-High", "5-lOW") | said.like("4-not spec%"))
    return rows.select("location_id", "type_of_water_source", "statements")


@register("join_case_blind")
def join_case_blind(spark, d):
    """Source types that were typed in another case still find their sources."""
    t = _t(spark, d)
    typed = R.auditor_report(t).groupBy(F.upper("type_of_water_source").alias("typed")).agg(
        F.count(F.lit(1)).alias("reports"))
    totals = profile.people_by_type(R.water_source(t))
    same = case_blind("typed") == case_blind("type_of_water_source")
    return totals.join(typed, same).select("type_of_water_source", "typed", "reports", "total_people_served")


@register("group_case_blind")
def group_case_blind(spark, d):
    """Statements counted without regard to case; each group shows its first spelling by bytes."""
    t = _t(spark, d)
    said = R.auditor_report(t).select("statements")
    both = said.unionAll(said.select(F.lower("statements").alias("statements")))
    return (both.groupBy(case_blind("statements").alias("_ws_key"))
            .agg(F.min(plain("statements")).alias("statements"), F.count(F.lit(1)).alias("n"),
                 F.count_distinct(plain("statements")).alias("spellings")).drop("_ws_key"))

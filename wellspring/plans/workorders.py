"""W10 work orders with a data-quality gate, and W11 progress roll-up."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wellspring.functions import first_match, percent
from wellspring.operators import append_batch, materialize
from wellspring.plans import clean
from wellspring.plans.access import located_sources
from wellspring.session import table_path

# ---------------------------------------------------------------------------
# Fixed values of the work-order job.
# ---------------------------------------------------------------------------
CHEMICAL = "Contaminated: Chemical"
BIOLOGICAL = "Contaminated: Biological"
CLEAN = "Clean"
RIVER, SHARED_TAP, BROKEN_TAP = "river", "shared_tap", "tap_in_home_broken"
QUEUE_MINUTES_PER_TAP = 30
INSTALL_RO, INSTALL_UV, DRILL_WELL = "Install RO filter", "Install UV filter", "Drill well"
DIAGNOSE = "Diagnose infrastructure"
NO_IMPROVEMENT = "Null"  # the survey writes the text 'Null', not a NULL
IN_PROGRESS, BACKLOG, COMPLETE = "In progress", "Backlog", "Complete"
STATUSES = [BACKLOG, IN_PROGRESS, COMPLETE]
DEFAULT_COMMENT = "Monitoring required"
# Declared widths of the output table's text columns.
MAX_LENGTHS = [
    ("address", 50),
    ("town_name", 30),
    ("province_name", 30),
    ("source_id", 20),
    ("type_of_water_source", 50),
    ("Improvement", 50),
    ("Source_status", 50),
]
OUTPUT_COLUMNS = ["address", "town_name", "province_name", "source_id", "type_of_water_source",
                  "Improvement", "Source_status", "Date_of_completion", "Comments"]
# Run date of the registered (compared) queries; library calls default to today.
REGISTERED_RUN_DATE = "2024-01-31"


def improvement(queue_threshold: int = QUEUE_MINUTES_PER_TAP, null_text: bool = True) -> Column:
    """First matching rule wins. With ``null_text=False`` a source no rule
    matches gets a real NULL instead of the survey's text 'Null'."""
    results, kind, queue = F.col("results"), F.col("type_of_water_source"), F.col("time_in_queue")
    taps = F.floor(queue / QUEUE_MINUTES_PER_TAP).cast("bigint").cast("string")
    return first_match([
        (results == CHEMICAL, F.lit(INSTALL_RO)),
        (results == BIOLOGICAL, F.lit(INSTALL_UV)),
        (kind == RIVER, F.lit(DRILL_WELL)),
        ((kind == SHARED_TAP) & (queue >= queue_threshold),
         F.concat(F.lit("Install "), taps, F.lit(" taps nearby"))),
        (kind == BROKEN_TAP, F.lit(DIAGNOSE)),
    ], F.lit(NO_IMPROVEMENT) if null_text else F.lit(None).cast("string"))


def status() -> Column:
    return first_match([(F.col("results").isin(CHEMICAL, BIOLOGICAL), F.lit(IN_PROGRESS))], F.lit(BACKLOG))


def needs_work(queue_threshold: int = QUEUE_MINUTES_PER_TAP) -> Column:
    """Polluted, a river or broken tap, or a shared tap with a long queue.
    A source without a pollution row has an unknown result, so only the
    other two branches can select it."""
    kind = F.col("type_of_water_source")
    return ((F.col("results") != CLEAN)
            | kind.isin(BROKEN_TAP, RIVER)
            | ((kind == SHARED_TAP) & (F.col("time_in_queue") >= queue_threshold)))


def work_orders(sources: DataFrame, pollution: DataFrame, visits: DataFrame, location: DataFrame,
                run_date: str | None = None, queue_threshold: int = QUEUE_MINUTES_PER_TAP,
                comment: str = DEFAULT_COMMENT, null_text: bool = True, cleaned: bool = False) -> DataFrame:
    """One order per first visit of a source that needs work, in the output
    table's column order. ``run_date`` (ISO date, default today) is the
    completion date written on every order. ``cleaned`` corrects the
    pollution results first (the survey itself planned from the uncorrected
    table)."""
    run_date = run_date or dt.date.today().isoformat()
    if cleaned:
        pollution = clean.correct(pollution)
    v = visits.filter(F.col("visit_count") == 1).select("record_id", "source_id", "location_id", "time_in_queue")
    loc = location.select("location_id", "address", "town_name", "province_name")
    rows = located_sources(v, sources, pollution, loc).filter(needs_work(queue_threshold))
    return rows.select(
        "address", "town_name", "province_name",
        F.col("source_id").cast("string").alias("source_id"),
        "type_of_water_source",
        improvement(queue_threshold, null_text).alias("Improvement"),
        status().alias("Source_status"),
        F.lit(dt.date.fromisoformat(run_date)).alias("Date_of_completion"),
        F.lit(comment).alias("Comments"),
    )


def _row_rules() -> list[Column]:
    """Rules that look at one order at a time, as aggregate counts."""
    status_col = F.coalesce(F.col("Source_status"), F.lit(BACKLOG))
    return [
        F.count(F.lit(1)).alias("orders_checked"),
        F.count_if(F.col("source_id").isNull()).cast("bigint").alias("null_source_id"),
        F.count_if(~status_col.isin(*STATUSES)).cast("bigint").alias("invalid_status"),
        *[F.count_if(F.length(F.col(c)) > n).cast("bigint").alias(f"{c.lower()}_too_long")
          for c, n in MAX_LENGTHS],
    ]


def unknown_source_rows(orders: DataFrame, sources: DataFrame) -> DataFrame:
    """One row: how many orders name a source id that is not in ``sources``."""
    return violations(orders, sources, []).select("unknown_source_id")


def violations(orders: DataFrame, sources: DataFrame, rules: list[Column] | None = None) -> DataFrame:
    """One row of rule-violation counts for a batch of work orders.

    Parquet enforces neither NOT NULL nor CHECK nor REFERENCES, so the declared
    constraints are checked here, in one pass over the orders: all rules are
    counted per source id (partial counts per task, so a source with a third
    of the orders costs nothing), only those counts, one row per id, meet the
    distinct known ids, and their sums are the answer.
    """
    rules = _row_rules() if rules is None else rules
    per_id = orders.groupBy("source_id").agg(F.count(F.lit(1)).alias("_ws_n"), *rules)
    names = [c for c in per_id.columns if c not in ("source_id", "_ws_n")]
    known = (sources.select(F.col("source_id").cast("string").alias("source_id")).distinct()
             .withColumn("_ws_known", F.lit(True)))
    unknown = F.when(F.col("source_id").isNotNull() & F.col("_ws_known").isNull(), F.col("_ws_n")).otherwise(0)
    total = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in names]
    return per_id.join(known, "source_id", "left").agg(
        *total, F.coalesce(F.sum(unknown), F.lit(0)).cast("bigint").alias("unknown_source_id"))


def publish_work_orders(orders: DataFrame, sources: DataFrame, run_date: str | None = None,
                        table: str = "project_progress", path: str | None = None,
                        batch: str | None = None) -> DataFrame:
    """Stage the batch, check it, append it under its run date, and read the run date back.

    The orders are computed once into a staging folder, with a digest of their
    rows gathered in the same pass (``observe``); the rules then read the
    staged rows. Only a clean batch is appended, as ``batch`` (by default
    the digest) of the run date: batches add up, the same batch is appended
    once. Returns all rows that the table holds for the run date, as of now.
    """
    spark = orders.sparkSession
    run_date = run_date or dt.date.today().isoformat()
    seen = Observation("work_order_batch")
    digest = F.sum(F.xxhash64(*OUTPUT_COLUMNS).cast("decimal(38,0)")).cast("string")
    staged = materialize(orders.observe(seen, F.count(F.lit(1)).alias("rows"), digest.alias("digest")), table + "_staging")
    found = violations(staged, sources).first().asDict()
    bad = {k: v for k, v in found.items() if k != "orders_checked" and v}
    if bad:
        raise ValueError(f"work orders rejected, rule violations: {bad}")
    path = path or table_path(spark, table)
    append_batch(staged, path, "run_date", run_date, batch or f"{seen.get['rows']}_{seen.get['digest']}")
    return spark.read.parquet(f"{path}/run_date={run_date}").select(*OUTPUT_COLUMNS)


def progress_rollup(orders: DataFrame) -> DataFrame:
    """Order counts and status mix at national, province and town level.

    ``level`` is the grouping id: 0 = town, 1 = province, 3 = national. The orders are counted once, per town; provinces
    and the country add up those few rows (a roll-up over the orders would read each of them three times).
    """
    st = F.coalesce(F.col("Source_status"), F.lit(BACKLOG))
    towns = orders.groupBy("province_name", "town_name").agg(
        F.count(F.lit(1)).alias("_ws_orders"),
        F.count_if(st == COMPLETE).cast("bigint").alias("_ws_complete"),
        F.count_if(st == IN_PROGRESS).cast("bigint").alias("_ws_progress"),
        F.count_if(st == BACKLOG).cast("bigint").alias("_ws_backlog"))

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return towns.rollup("province_name", "town_name").agg(
        total("_ws_orders").alias("work_orders"), total("_ws_complete").alias("complete"),
        total("_ws_progress").alias("in_progress"), total("_ws_backlog").alias("backlog"),
        percent(total("_ws_complete"), total("_ws_orders"), 2).alias("pct_complete"),
        F.grouping_id().cast("bigint").alias("level"))

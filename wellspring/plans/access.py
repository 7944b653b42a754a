"""W8 combined analysis view and W9 access by province and town."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.functions import percent, safe_ratio_pct
from wellspring.operators import hot_keys_by, materialize, skew_join, skew_join_chain
from wellspring.plans import clean

# The five source types, in the survey's column order.
SOURCE_TYPES = ["river", "shared_tap", "tap_in_home", "tap_in_home_broken", "well"]
CLEAN = "Clean"


def repeated_sources(pollution: DataFrame) -> DataFrame:
    """Sources with more than one pollution row (should be none).

    The view joins pollution results onto visits by source; a repeated
    source would repeat its visits and inflate people served, so run this
    check on a new pollution table before trusting the shares.
    """
    return (pollution.groupBy("source_id").agg(F.count(F.lit(1)).alias("rows"))
            .filter(F.col("rows") > 1))


def combined_view(visits: DataFrame, pollution: DataFrame, location: DataFrame,
                  sources: DataFrame, cleaned: bool = False) -> DataFrame:
    """First visits with their source type, place, people served and result.

    The survey's later analyses read the pollution table as recorded (its
    corrections were applied to a copy that was then dropped); ``cleaned``
    applies the cleaning job's corrections first.

    The survey writes ``visits LEFT JOIN well_pollution JOIN location JOIN
    water_source``; both source joins use the visit's source_id, so they are
    chained on one salted partitioning, then one join on location_id. The
    big table is shuffled twice instead of three times, and both of its
    shuffles split hot sources and hot sites over several tasks.
    """
    v = visits.filter(F.col("visit_count") == 1).select("record_id", "source_id", "location_id", "time_in_queue")
    loc = location.select("location_id", "town_name", "province_name", "location_type")
    if cleaned:
        pollution = clean.correct(pollution)
    return (located_sources(v, sources, pollution, loc)
            .select(F.col("type_of_water_source").alias("source_type"), "town_name",
                    "province_name", "location_type",
                    F.col("number_of_people_served").alias("people_served"),
                    "time_in_queue", "results"))


def located_sources(visits: DataFrame, sources: DataFrame, pollution: DataFrame,
                    location: DataFrame) -> DataFrame:
    """Visits joined to their source and pollution result (on source_id) and
    their site (on location_id).

    ``visits ⋈ sources ⟕ pollution`` equals ``visits ⋈ (sources ⟕ pollution)``
    because both joins use the visit's source_id; written as one salted chain
    on source_id, the visits are shuffled once for both. Hot values of both
    keys are found in one scan of the visits, before any join.
    """
    hot = hot_keys_by(visits, ["source_id", "location_id"])
    by_source = skew_join_chain(visits, "source_id",
                                [(sources, "inner"), (pollution.select("source_id", "results"), "left")],
                                hot=hot["source_id"], row_key=["record_id"])
    return skew_join(by_source, location, "location_id", hot=hot["location_id"], row_key=["record_id"])


def source_share(view: DataFrame, keys: Sequence[str], types: Sequence[str] = SOURCE_TYPES,
                 digits: int = 0) -> DataFrame:
    """Percent of people per source type inside each group; a type with no
    source in the group gives 0.

    The survey joins the view to a per-group total and then sums per type;
    both are sums over the same group, so here they come out of a single
    aggregation (one shuffle, partial sums per task).
    """
    per_type = [F.sum(F.when(F.col("source_type") == t, F.col("people_served")).otherwise(0))
                .alias("_ws_" + t) for t in types]
    sums = view.groupBy(*keys).agg(*per_type, F.sum("people_served").alias("_ws_total"))
    return sums.select(*keys, *[percent(F.col("_ws_" + t), F.col("_ws_total"), digits).alias(t)
                                for t in types])


def province_share(view: DataFrame) -> DataFrame:
    return source_share(view, ["province_name"]).orderBy("province_name")


def town_share(view: DataFrame) -> DataFrame:
    """Per (province, town): town labels repeat across provinces."""
    return source_share(view, ["province_name", "town_name"]).orderBy("town_name")


def town_access_table(view: DataFrame) -> DataFrame:
    """The town shares stored once (temporary table) and read back."""
    return materialize(source_share(view, ["province_name", "town_name"]), "town_aggregated_water_access")


def broken_tap_ratio(town_access: DataFrame) -> DataFrame:
    """Broken share of in-home taps per town, from the rounded percents
    stored in the town table; NULL for a town without home taps."""
    return town_access.select(
        "province_name", "town_name",
        safe_ratio_pct(F.col("tap_in_home_broken"), F.col("tap_in_home"), 0).alias("Pct_broken_taps"),
        safe_ratio_pct(F.col("tap_in_home"), F.col("tap_in_home_broken"), 0).alias("pct_home"),
    )


def broken_tap_ratio_exact(view: DataFrame) -> DataFrame:
    """Broken share of in-home taps per town from unrounded people counts
    (the survey's ratio divides percents that were already rounded)."""
    t, people = F.col("source_type"), F.col("people_served")
    sums = view.groupBy("province_name", "town_name").agg(
        F.sum(F.when(t == "tap_in_home_broken", people).otherwise(0)).alias("_ws_broken"),
        F.sum(F.when(t == "tap_in_home", people).otherwise(0)).alias("_ws_home"))
    return sums.select(
        "province_name", "town_name",
        safe_ratio_pct(F.col("_ws_broken"), F.col("_ws_home"), 0).alias("Pct_broken_taps"),
        safe_ratio_pct(F.col("_ws_home"), F.col("_ws_broken"), 0).alias("pct_home"),
    )


def headline_shares(view: DataFrame) -> DataFrame:
    """The report's headline figures in one pass over the view."""
    people = F.col("people_served")
    t = F.col("source_type")

    def people_where(cond):
        return F.sum(F.when(cond, people).otherwise(0))

    home = people_where(t.isin("tap_in_home", "tap_in_home_broken"))
    wells = people_where(t == "well")
    return view.agg(
        percent(people_where(t == "shared_tap"), F.sum(people), 0).alias("shared_tap_pct"),
        percent(home, F.sum(people), 0).alias("home_tap_pct"),
        percent(people_where(t == "tap_in_home_broken"), home, 0).alias("broken_within_home_pct"),
        percent(wells, F.sum(people), 0).alias("well_pct"),
        percent(people_where((t == "well") & (F.col("results") == CLEAN)), wells, 0)
        .alias("clean_within_wells_pct"),
        F.round(F.avg(F.nullif(F.col("time_in_queue"), F.lit(0))), 4).alias("avg_queue_minutes"),
    )

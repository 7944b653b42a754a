"""The survey's large tables in co-partitioned storage, and the jobs that join them without a shuffle.

The visits are stored twice, by what they are joined on: by source for the combined view (with the sources and
their pollution results in the same buckets) and by record for the audit (with the quality scores). Both copies
hold all visits, a heavy key's rows cut into pieces (``operators.layout``), so the tables are written once
and every later analysis reads matching buckets side by side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.operators import (bucketed_join, drop_bucketed, heavy_keys, layout_for, skew_join, store_dim,
                                  store_fact)
from wellspring.operators.layout import SALT

VISIT_COLUMNS = ["record_id", "location_id", "source_id", "assigned_employee_id", "visit_count", "time_in_queue"]


@dataclass
class StoredBySource:
    spark: SparkSession
    visits: str
    sources: str
    pollution: str

    def drop(self) -> None:
        drop_bucketed(self.spark, self.visits, self.sources, self.pollution)


@dataclass
class StoredByRecord:
    spark: SparkSession
    visits: str
    quality: str

    def drop(self) -> None:
        drop_bucketed(self.spark, self.visits, self.quality)


def store_by_source(visits: DataFrame, sources: DataFrame, pollution: DataFrame,
                    buckets: int | None = None) -> StoredBySource:
    """Visits, sources and pollution results in buckets of the source."""
    layout = layout_for(visits, "source_id", buckets)
    return StoredBySource(
        visits.sparkSession, store_fact(visits.select(*VISIT_COLUMNS), "visits_by_source", layout, ["record_id"]),
        store_dim(sources, "sources", layout), store_dim(pollution, "pollution", layout))


def store_by_record(visits: DataFrame, quality: DataFrame, buckets: int | None = None) -> StoredByRecord:
    """Visits and quality scores in buckets of the record."""
    layout = layout_for(visits, "record_id", buckets)
    kept = [*VISIT_COLUMNS[:-1]]
    return StoredByRecord(visits.sparkSession, store_fact(visits.select(*kept), "visits_by_record", layout),
                          store_dim(quality, "quality", layout))


def combined_view(stored: StoredBySource, location: DataFrame) -> DataFrame:
    """The combined analysis view from stored tables: the joins on the source exchange nothing, the visits are
    shuffled once, for the site (a site with many visits is split)."""
    spark = stored.spark
    first = spark.table(stored.visits).filter(F.col("visit_count") == 1)
    hot = heavy_keys(first, ["location_id"], min_rows=5000)["location_id"]
    sourced = bucketed_join(spark, first.select("record_id", "source_id", "location_id", "time_in_queue", SALT),
                            [(stored.sources, "inner"), (stored.pollution, "left")], "source_id")
    sites = location.select("location_id", "town_name", "province_name", "location_type")
    return (skew_join(sourced, sites, "location_id", hot=hot, row_key=["record_id"])
            .select(F.col("type_of_water_source").alias("source_type"), "town_name", "province_name", "location_type",
                    F.col("number_of_people_served").alias("people_served"), "time_in_queue", "results"))


def audit_pairs(stored: StoredByRecord, auditor: DataFrame, first_visit_only: bool = True) -> DataFrame:
    """Auditor rows with the surveyors' visits and scores of the same site, from stored tables: the join on the record
    exchanges nothing, the visits are shuffled once, for the site."""
    spark = stored.spark
    visits = spark.table(stored.visits)
    if first_visit_only:
        visits = visits.filter(F.col("visit_count") == 1)
    hot = heavy_keys(visits, ["location_id"], min_rows=5000)["location_id"]
    scored = bucketed_join(spark, visits.drop("visit_count"), [(stored.quality, "inner")], "record_id")
    v = scored.select("location_id", "record_id", "assigned_employee_id", "source_id",
                      F.col("subjective_quality_score").alias("surveyor_score"))
    a = auditor.select("location_id", F.col("type_of_water_source").alias("auditor_source"),
                       F.col("true_water_source_score").alias("auditor_score"), "statements")
    return skew_join(v, a, "location_id", hot=hot, row_key=["record_id"])

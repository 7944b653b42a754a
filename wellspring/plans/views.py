"""The survey's tables and views as Spark SQL temporary views.

A user who works in SQL registers the survey tables once and keeps writing
SQL: ``combined_analysis_table`` and ``Incorrect_records`` are the survey's
two views, built by the same DataFrame jobs as everything else. ``water_quality`` is
one of the tables; a survey without one gets it from the scores on its visits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wellspring.plans import access, audit
from wellspring.sources import Tables
from wellspring.sources import roles as R

BASE = ["location", "visits", "water_source", "well_pollution", "employee", "auditor_report", "queue_log",
        "water_quality"]


def role_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The survey tables derived from the driver's tables."""
    t = Tables(spark, sf_dir)
    return {name: getattr(R, name)(t) for name in BASE}


def register_survey_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Register base tables plus the survey's views; returns the view names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    visits = tables["visits"]
    names = list(tables)
    if "water_quality" not in tables and "subjective_quality_score" in visits.columns:
        visits.select("record_id", "subjective_quality_score", "visit_count") \
            .createOrReplaceTempView("water_quality")
        names.append("water_quality")
    access.combined_view(visits, tables["well_pollution"], tables["location"],
                         tables["water_source"]).createOrReplaceTempView("combined_analysis_table")
    quality = tables.get("water_quality")
    audit.incorrect_records(tables["auditor_report"], visits, tables["employee"], quality) \
        .select("location_id", "record_id", "employee_name", "auditor_score", "surveyor_score",
                "statements").createOrReplaceTempView("Incorrect_records")
    return names + ["combined_analysis_table", "Incorrect_records"]


def drop_survey_views(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        spark.catalog.dropTempView(name)


__all__ = ["BASE", "drop_survey_views", "register_survey_views", "role_tables"]

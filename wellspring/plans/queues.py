"""W5 queue analysis: survey span, mean queue, by weekday, by hour, heat map.

Input: a visit log with ``time_of_record`` (timestamp) and ``time_in_queue``
(minutes, 0 = no queue). Every result is a grouped aggregate, so each job is
one scan with per-task partial aggregation and one small shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.functions import WEEKDAYS, day_span, hour_label, hour_of_day, mean4, weekday_name

TS = "time_of_record"
Q = "time_in_queue"
DAYS_PER_YEAR = 365


def survey_span(log: DataFrame) -> DataFrame:
    """First and last record, days between them, and the same in years."""
    first, last = F.min(TS), F.max(TS)
    return log.agg(
        first.alias("survey_start"),
        last.alias("survey_end"),
        day_span(last, first).alias("survey_duration_days"),
        F.round(day_span(last, first) / DAYS_PER_YEAR, 4).alias("survey_duration_years"),
    )


def mean_queue_filtered(log: DataFrame) -> DataFrame:
    """Mean queue over visits that had a queue (filter form)."""
    return log.filter(F.col(Q) > 0).agg(mean4(F.col(Q)).alias("avg_queue_time_minutes"))


def mean_queue_nullif(log: DataFrame) -> DataFrame:
    """Same mean, zeros turned to NULL so AVG skips them."""
    return log.agg(mean4(F.nullif(F.col(Q), F.lit(0))).alias("avg_queue_time_minutes"))


def queue_by_weekday(log: DataFrame) -> DataFrame:
    return (log.filter(F.col(Q) > 0)
            .groupBy(weekday_name(F.col(TS)).alias("day_of_week"))
            .agg(F.round(F.avg(Q), 0).alias("avg_queue_time")))


def queue_by_hour(log: DataFrame) -> DataFrame:
    return (log.filter(F.col(Q) > 0)
            .groupBy(hour_of_day(F.col(TS)).alias("hour_of_day"))
            .agg(F.round(F.avg(Q), 0).alias("avg_queue_time"))
            .orderBy("hour_of_day"))


def queue_by_hour_label(log: DataFrame) -> DataFrame:
    return (log.filter(F.col(Q) > 0)
            .groupBy(hour_label(F.col(TS)).alias("hour_of_day"))
            .agg(F.round(F.avg(Q), 0).alias("avg_queue_time"))
            .orderBy("hour_of_day"))


def queue_heatmap(log: DataFrame) -> DataFrame:
    """Hour rows x weekday columns of mean queue; a cell with no visit is NULL.

    One aggregation with a conditional mean per weekday: a single shuffle of
    per-task partial sums (``groupBy().pivot()`` would aggregate by
    (hour, day) first and pivot in a second aggregation).
    """
    day = weekday_name(F.col(TS))
    cells = [F.round(F.avg(F.when(day == d, F.col(Q))), 0).alias(d) for d in WEEKDAYS]
    return (log.filter(F.col(Q) != 0)
            .groupBy(hour_label(F.col(TS)).alias("hour_of_day"))
            .agg(*cells)
            .orderBy("hour_of_day"))

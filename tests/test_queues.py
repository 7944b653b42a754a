"""W5 queue analysis on edge rows (FIXTURES.md: queue_edges, empty_pivot_cell)."""

import datetime as dt

from wellspring.plans import queues


def _log(spark):
    rows = [
        (dt.datetime(2024, 1, 6, 6, 15), 0),     # Saturday, no queue
        (dt.datetime(2024, 1, 6, 6, 45), 30),
        (dt.datetime(2024, 1, 6, 18, 5), 60),
        (dt.datetime(2024, 1, 8, 6, 10), 29),    # Monday
        (dt.datetime(2024, 1, 8, 6, 20), None),  # unknown queue
        (dt.datetime(2024, 1, 9, 7, 0), 501),    # Tuesday
    ]
    return spark.createDataFrame(rows, "time_of_record timestamp_ntz, time_in_queue int")


def test_mean_forms_agree_and_skip_zero_and_null(spark):
    a = queues.mean_queue_filtered(_log(spark)).first()[0]
    b = queues.mean_queue_nullif(_log(spark)).first()[0]
    assert a == b == 155.0


def test_span_in_days_and_years(spark):
    r = queues.survey_span(_log(spark)).first()
    assert r.survey_duration_days == 3
    assert r.survey_duration_years == round(3 / 365, 4)


def test_weekday_names_are_full(spark):
    got = {r.day_of_week: r.avg_queue_time for r in queues.queue_by_weekday(_log(spark)).collect()}
    assert got == {"Saturday": 45.0, "Monday": 29.0, "Tuesday": 501.0}


def test_hour_label_format(spark):
    got = [(r.hour_of_day, r.avg_queue_time) for r in queues.queue_by_hour_label(_log(spark)).collect()]
    assert got == [("06:00", 30.0), ("07:00", 501.0), ("18:00", 60.0)]


def test_heatmap_cells_null_when_empty(spark):
    hm = queues.queue_heatmap(_log(spark))
    assert hm.columns == ["hour_of_day", "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday",
                          "Friday", "Saturday"]
    rows = {r.hour_of_day: r for r in hm.collect()}
    assert rows["06:00"].Saturday == 30.0 and rows["06:00"].Monday == 29.0
    assert rows["06:00"].Sunday is None
    assert rows["18:00"].Saturday == 60.0 and rows["18:00"].Monday is None
    assert rows["07:00"].Tuesday == 501.0

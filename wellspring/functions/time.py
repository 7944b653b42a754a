"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Full English weekday names, in the survey's column order.
WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def weekday_name(ts: Column) -> Column:
    """Full weekday name ('Saturday'); Spark's ``dayname`` gives 'Sat'.

    Looked up by ``dayofweek`` (1 = Sunday), so a wall-clock timestamp is
    never shifted through the session time zone.
    """
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.dayofweek(ts))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def hour_label(ts: Column) -> Column:
    """Hour as 'HH:00' text, e.g. '06:00'."""
    return F.concat(F.lpad(F.hour(ts).cast("string"), 2, "0"), F.lit(":00"))


def day_span(late: Column, early: Column) -> Column:
    """Calendar days between two instants (date parts only)."""
    return F.datediff(late, early).cast("bigint")

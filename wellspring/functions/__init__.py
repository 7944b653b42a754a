"""Column expressions built from Spark built-ins only (no Python UDFs)."""

from wellspring.functions.numeric import mean4, percent, safe_ratio_pct
from wellspring.functions.rules import apply_updates, first_match
from wellspring.functions.text import byte_length, case_blind, email_address, mentions, plain
from wellspring.functions.time import WEEKDAYS, day_span, hour_label, hour_of_day, weekday_name

__all__ = [
    "WEEKDAYS", "apply_updates", "byte_length", "case_blind", "day_span", "email_address", "first_match",
    "hour_label", "hour_of_day", "mean4", "mentions", "percent", "plain", "safe_ratio_pct", "weekday_name",
]

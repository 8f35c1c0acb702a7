"""Column expressions: numbers, pickup times and row rules."""

from tripmetrics.functions.numbers import (
    minutes,
    num,
    number_or_null,
    plain_number,
    positive,
    present,
    ratio,
    ratio_or_zero,
    rounded,
    text,
)
from tripmetrics.functions.rules import clean_trip, keys_present
from tripmetrics.functions.times import FORMATS, PICKUP_RULES, event_hour, event_time

__all__ = [
    "FORMATS",
    "PICKUP_RULES",
    "clean_trip",
    "event_hour",
    "event_time",
    "keys_present",
    "minutes",
    "num",
    "number_or_null",
    "plain_number",
    "positive",
    "present",
    "ratio",
    "ratio_or_zero",
    "rounded",
    "text",
]

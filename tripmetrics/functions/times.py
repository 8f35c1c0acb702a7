"""Pickup times as column expressions: several text forms, parsed by local clock.

Everything is parsed to TIMESTAMP_NTZ, so the hour is the hour that was written
down, whatever the session time zone and its daylight-saving gaps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, TimestampNTZType, TimestampType

from tripmetrics.functions.numbers import ColumnOrName, col

# The accepted date-time forms (year-month-day, month/day/year and
# ISO with T). Month, day, hour, minute and second may have one digit; date and
# time may stand further apart than one blank. Each form is a list of patterns
# with the rewrite that the timestamp cast needs, or None where it reads the
# text as it is, which is what nearly every row takes.
_CLOCK = r"(\d{1,2}:\d{1,2}:\d{1,2})$"
FORMATS = {
    "ymd": (
        (r"^\d{4}-\d{1,2}-\d{1,2} " + _CLOCK, None),
        (r"^(\d{4}-\d{1,2}-\d{1,2})\s+" + _CLOCK, "$1 $2"),
    ),
    "mdy": ((r"^(\d{1,2})/(\d{1,2})/(\d{4})\s+" + _CLOCK, "$3-$1-$2 $4"),),
    "iso": ((r"^\d{4}-\d{1,2}-\d{1,2}T" + _CLOCK, None),),
}

# How a pickup text is treated: strip blanks, cut to this many characters, forms tried.
PICKUP_RULES = {
    "strict": (False, None, ("ymd",)),
    "cut": (False, 19, ("ymd",)),
    "multi": (True, 19, ("ymd", "mdy", "iso")),
}
_BLANKS = " \t\n\r\x0b\x0c"


def event_time(c: ColumnOrName, rule: str = "strict") -> Column:
    """Text as TIMESTAMP_NTZ by the first form that fits, else null."""
    strip, width, forms = PICKUP_RULES[rule]
    t = col(c)
    if strip:
        t = F.btrim(t, F.lit(_BLANKS))
    if width:
        t = F.substring(t, 1, width)
    cases = [_case(t, pattern, rewrite) for f in forms for pattern, rewrite in FORMATS[f]]
    return F.coalesce(*cases)


def _case(t: Column, pattern: str, rewrite: str | None) -> Column:
    readable = t if rewrite is None else F.regexp_replace(t, pattern, rewrite)
    return F.when(t.rlike(pattern), readable.try_cast("timestamp_ntz"))


def event_hour(c: ColumnOrName, dtype: DataType, rule: str = "strict") -> Column:
    """Hour of day of a pickup column, chosen by its type when the plan is built.

    Real timestamps give their hour, text is parsed by ``rule``, any other type
    cannot be a pickup time and gives null.
    """
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.hour(col(c))
    if isinstance(dtype, StringType):
        return F.hour(event_time(c, rule))
    return F.lit(None).cast("int")

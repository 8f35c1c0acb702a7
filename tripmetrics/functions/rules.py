"""Row rules: which trips count for which question."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmetrics.functions.numbers import num, positive, present


def clean_trip() -> Column:
    """Time above zero and a total present; null counts as not clean.

    Left as plain conjuncts, so that each one can reach a columnar scan.
    """
    return positive(num("trip_time_in_secs")) & present(num("total_amount"))


def keys_present(*names: str) -> Column:
    rule = F.lit(True)
    for name in names:
        rule = rule & F.col(name).isNotNull()
    return rule

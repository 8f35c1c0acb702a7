"""Pickup times against the standard library, in a session zone with daylight saving."""

from datetime import date, datetime

import pytest

from conftest import rows
from pyspark.sql import functions as F
from tripmetrics.functions import event_hour, event_time

TEXTS = [
    "2013-03-10 02:30:00", "2013-1-1 7:02:03", "2013-01-01  05:00:00", "2013-01-01\t05:00:00",
    "01/03/2013 05:00:00", "1/3/2013  5:0:0", "2013-01-01T05:00:00", "2013-1-1T5:0:0",
    " 2013-01-01 05:00:00 ", "2013-02-30 05:00:00", "2013-01-01 24:00:00", "2013-01-01", "x", "",
    "2013-01-01 05:00:00.5", "2013-01-01 05:00:60", "13/01/2013 05:00:00", "2013-01-01 5:00",
    "2013-01-01 05:00:00Z", "2013-01-01 05:00:00 ", "\t2013-01-01 05:00:00\x0b", None,
]
RULES = {
    "strict": (lambda s: s, ["%Y-%m-%d %H:%M:%S"]),
    "cut": (lambda s: s[:19], ["%Y-%m-%d %H:%M:%S"]),
    "multi": (
        lambda s: s.strip()[:19],
        ["%Y-%m-%d %H:%M:%S", "%m/%d/%Y %H:%M:%S", "%Y-%m-%dT%H:%M:%S"],
    ),
}


def expected(text, rule):
    prepare, formats = RULES[rule]
    for form in formats if text is not None else []:
        try:
            return datetime.strptime(prepare(text), form)
        except ValueError:
            continue
    return None


@pytest.mark.parametrize("rule", RULES)
def test_text_times(spark, rule):
    df = spark.createDataFrame([(t,) for t in TEXTS], "s string")
    found = dict(rows(df.select("s", event_time("s", rule))))
    assert found == {t: expected(t, rule) for t in TEXTS}


def test_hour_follows_the_type(spark):
    df = spark.sql(
        "select timestamp_ntz'2013-03-10 02:30:00' ntz, timestamp'2013-01-01 05:00:00' ts, "
        "'2013-01-01 07:00:00' txt, date'2013-01-01' d"
    )
    hours = [event_hour(c, df.schema[c].dataType) for c in df.columns]
    assert rows(df.select(*hours)) == [(2, 5, 7, None)]
    assert df.first()["d"] == date(2013, 1, 1)
    assert df.select(F.typeof(hours[3])).first()[0] == "int"

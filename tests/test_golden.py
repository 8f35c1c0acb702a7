"""The hand-made fixture, with answers worked out by an independent engine."""

import pytest

from conftest import rows
from pyspark.sql import functions as F
from tripmetrics import operators as op
from tripmetrics import sources


def rounded(found, digits=6):
    return [(k, round(v, digits)) for k, v in found]


def by_hour(df):
    return {r["hour"]: (r["avg_ratio"], r["trips"]) for r in df.collect()}


def test_hourly_ratio_strict(golden_trips):
    found = by_hour(op.hourly_ratio(golden_trips))
    assert found == {17: (1.25, 2), 18: (0.5, 1), 5: (0.375, 3), 3: (0.0, 1)}


def test_best_hour_strict(golden_trips):
    assert rows(op.best_hour(golden_trips)) == [(17, 1.25)]


def test_hourly_ratio_three_formats(golden_trips):
    found = by_hour(op.hourly_ratio(golden_trips, "multi"))
    assert found == {5: (2.53125, 4), 17: (1.25, 2), 18: (0.5, 1), 3: (0.0, 1)}


def test_best_hour_three_formats(golden_trips):
    assert rows(op.best_hour(golden_trips, "multi")) == [(5, 2.53125)]


def test_top_drivers(golden_trips):
    expected = [("H3", 6.5), ("H4", 4.0), ("H5", 2.5), ("H2", 2.25), ("H1", 1.685714)]
    assert rounded(rows(op.top_drivers(golden_trips))) == expected


def test_top_taxis(golden_trips):
    assert rows(op.top_taxis(golden_trips)) == [("M3", 3), ("M1", 2), ("M2", 2), ("M5", 1)]
    assert rows(op.top_taxis(golden_trips, scope="clean")) == [("M1", 2), ("M2", 2), ("M3", 2)]
    approx = op.top_taxis(golden_trips, method="approx", scope="clean")
    assert rows(approx) == [("M1", 2), ("M2", 2), ("M3", 2)]


def test_both_rankings(golden_trips):
    found = op.both_rankings(golden_trips).orderBy("ranking", "place")
    got = [(r["ranking"], r["place"], r["key"], round(r["measure"], 6)) for r in found.collect()]
    assert got == [
        ("top_drivers", 1, "H3", 6.5),
        ("top_drivers", 2, "H4", 4.0),
        ("top_drivers", 3, "H5", 2.5),
        ("top_drivers", 4, "H2", 2.25),
        ("top_drivers", 5, "H1", 1.685714),
        ("top_taxis", 1, "M1", 2.0),
        ("top_taxis", 2, "M2", 2.0),
        ("top_taxis", 3, "M3", 2.0),
    ]


def test_run_facts(golden_trips):
    assert rows(op.run_facts(golden_trips)) == [(14, 10, 4)]


def test_line_facts(spark, golden_file):
    lines = sources.read_lines(spark, golden_file)
    assert rows(op.line_facts(lines)) == [(14, 2, 12, 0, 17)]
    assert rows(op.widest_line(lines)) == [(17,)]
    assert op.two_field_lines(lines).count() == 13


def test_normalize_agrees_with_conform(spark, golden_file, golden_trips):
    reduced = op.normalize(sources.read_trips(spark, golden_file, "lines"))
    assert rows(op.top_drivers(reduced)) == rows(op.top_drivers(golden_trips))
    assert rows(op.top_taxis(reduced)) == rows(op.top_taxis(golden_trips))


@pytest.mark.parametrize("fmt", ["csv_permissive", "lines"])
def test_every_text_reader_gives_the_same_answers(spark, golden_file, golden_trips, fmt):
    trips = op.conform(sources.read_trips(spark, golden_file, fmt, header=True, layout="trip17"))
    assert rows(op.best_hour(trips, "multi")) == rows(op.best_hour(golden_trips, "multi"))
    assert rows(op.top_drivers(trips)) == rows(op.top_drivers(golden_trips))
    assert rows(op.top_taxis(trips)) == rows(op.top_taxis(golden_trips))


def test_nan_and_infinite_figures(spark):
    trips = spark.createDataFrame(
        [
            ("M1", "H1", "2013-01-01 01:00:00", float("nan"), float("nan"), 1.0, 5.0),
            ("M1", "H2", "2013-01-01 01:00:00", 2.0, 60.0, float("nan"), float("nan")),
            ("M1", "H3", "2013-01-01 02:00:00", 2.0, 60.0, 1.0, 5.0),
        ],
        "medallion string, hack_license string, pickup_datetime string, trip_distance double, "
        "trip_time_in_secs double, surcharge double, total_amount double",
    )
    assert rows(op.hourly_ratio(trips)) == [(2, 0.5, 1)]
    assert rows(op.top_drivers(trips)) == [("H3", 5.0)]
    assert rows(op.run_facts(trips)) == [(3, 1, 2)]


def test_nothing_valid_gives_no_rows(spark, golden_trips):
    none = golden_trips.filter(F.lit(False))
    assert rows(op.best_hour(none)) == []
    assert rows(op.top_drivers(none)) == []
    assert rows(op.top_taxis(none)) == []
    assert rows(op.both_rankings(none)) == []
    assert rows(op.run_facts(none)) == [(0, 0, 0)]

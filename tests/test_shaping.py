"""Layouts, aliases, missing and extra columns."""

import pytest

from conftest import HEADER, rows
from pyspark.sql import functions as F
from tripmetrics import operators as op
from tripmetrics.plans import adapters
from tripmetrics.schema import CLASSIC17, CLASSIC20, CLASSIC21, LAYOUTS, REDUCED4, TRIP17
from tripmetrics.schema import TRIP17_NAMES


def by_layout(trips, layout):
    names, width = LAYOUTS[layout]
    return adapters.generic_columns(trips, names, width)


def test_layout_tables():
    assert len(TRIP17_NAMES) == 17 and ",".join(TRIP17_NAMES) == HEADER
    assert (len(CLASSIC21), len(CLASSIC20), len(CLASSIC17)) == (21, 19, 17)
    assert CLASSIC20 == (*CLASSIC21[:18], "total_amount")
    assert CLASSIC17 == (*CLASSIC21[:16], "total_amount")


@pytest.mark.parametrize("layout", LAYOUTS)
def test_every_layout_normalises_to_the_same_trips(lineitem_trips, layout):
    hint = layout if layout == "classic17" else None
    found = op.normalize(by_layout(lineitem_trips, layout), hint)
    assert found.schema == REDUCED4
    want = op.normalize(lineitem_trips)
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()


def test_layout_for_width():
    widths = {n: op.layout_for_width(n) for n in (16, 17, 18, 19, 20, 21, 30)}
    assert widths == {
        16: None, 17: "trip17", 18: None, 19: None, 20: "classic20", 21: "classic21",
        30: "classic21",
    }


def test_classic20_leaves_the_last_column_generic(lineitem_trips):
    named = op.rename_layout(by_layout(lineitem_trips, "classic20"), "classic20")
    assert named.columns[18:] == ["total_amount", "_c19"]


def test_layout_errors(lineitem_trips):
    narrow = by_layout(lineitem_trips, "trip17")
    with pytest.raises(ValueError, match="classic21 needs 21 columns, the input has 17"):
        op.normalize(narrow, "classic21")
    with pytest.raises(ValueError, match="unknown layout 'wide'"):
        op.rename_layout(narrow, "wide")


def test_aliases_first_match_wins_and_case_does_not_matter(spark):
    df = spark.sql(
        "select 'no' taxi_id, 'M' MED_ID, 'H' License, '60' as `DURATION`, 5 as Total, 7 total_amt"
    )
    assert rows(op.normalize(df)) == [("M", "H", 60.0, 7.0)]


def test_missing_columns_are_all_named(spark):
    df = spark.sql("select 'M' medallion, '60' duration")
    with pytest.raises(ValueError, match=r"\['hack_license', 'total_amount'\]"):
        op.normalize(df)


def test_generic_width_without_a_layout_is_an_error(spark):
    df = spark.sql("select 'M' _c0, 'H' _c1, '60' _c2")
    with pytest.raises(ValueError, match="missing required columns"):
        op.normalize(df)


def test_conform_names_adds_and_types(spark):
    df = spark.sql("select 'M' _c0, 'H' _c1, '2013-01-01 05:00:00' _c2, 'x' _c3, '382.5' _c4")
    found = op.conform(df, positional=True)
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in TRIP17]
    assert rows(found) == [("M", "H", "2013-01-01 05:00:00", "x", 382.5) + (None,) * 12]


def test_conform_drops_extra_columns_even_with_repeated_names(spark):
    cells = ", ".join(f"'{i}' as c" for i in range(19))
    df = spark.sql(f"select {cells}")
    assert op.extra_columns(df) == 2
    found = op.conform(df, positional=True)
    assert found.columns == TRIP17_NAMES
    assert found.first()["total_amount"] == 16.0


def test_conform_keeps_known_names_in_any_order_and_case(spark):
    df = spark.sql("select 'M' as Medallion, 'abc' as total_amount, '2.0' as trip_distance")
    row = op.conform(df).first()
    assert (row["medallion"], row["total_amount"], row["trip_distance"]) == ("M", None, 2.0)


def test_conform_resolves_aliases(spark):
    df = spark.sql("select 'M' as Taxi_ID, 'H' as license, '60' as duration, '2' as trip_distance")
    row = op.conform(df).first()
    assert tuple(row[c] for c in ("medallion", "hack_license", "trip_time_in_secs")) == ("M", "H", 60)
    assert (row["trip_distance"], row["total_amount"], row["pickup_datetime"]) == (2.0, None, None)


def test_name_columns(spark, lineitem_trips):
    assert op.name_columns(by_layout(lineitem_trips, "classic21")).columns == list(CLASSIC21)
    assert op.name_columns(by_layout(lineitem_trips, "classic17"), "classic17").columns == list(CLASSIC17)
    lost = lineitem_trips.toDF(*[f"x{i}" for i in range(17)])
    assert op.name_columns(lost).columns == TRIP17_NAMES
    assert op.name_columns(lineitem_trips).columns == TRIP17_NAMES


def test_lines_are_padded_and_blanks_kept_or_not(spark):
    lines = spark.createDataFrame([("a,,c",), ("",), ('"x,y",z,',)], "value string")
    assert sorted(rows(op.lines_to_columns(lines)), key=str) == sorted(
        [("a", "", "c", None), ("", None, None, None), ('"x', 'y"', "z", "")], key=str
    )
    blank = op.lines_to_columns(lines, 2, blank_as_null=True)
    assert sorted(rows(blank), key=str) == sorted([("a", None), (None, None), ('"x', 'y"')], key=str)


def test_no_lines_at_all(spark):
    lines = spark.createDataFrame([], "value string")
    assert len(op.lines_to_columns(lines).columns) == 17
    assert rows(op.two_field_lines(lines)) == []


def test_preview(lineitem_trips):
    reduced = op.normalize(lineitem_trips)
    first = op.preview(reduced, *reduced.columns).first()
    assert tuple(first) == min(rows(reduced))
    assert op.preview(reduced).count() == 1


def test_real_timestamps_and_decimals_are_accepted(spark):
    df = spark.sql(
        "select 'M' medallion, 'H' hack_license, timestamp'2013-01-01 05:00:00' pickup_datetime, "
        "cast(60 as int) trip_time_in_secs, cast(2.5 as decimal(9,2)) trip_distance, "
        "cast(5 as decimal(9,2)) surcharge, 12.5BD total_amount"
    )
    assert rows(op.best_hour(df)) == [(5, 2.0)]
    assert rows(op.top_drivers(df)) == [("H", 12.5)]
    assert [f.dataType for f in op.normalize(df).schema] == [f.dataType for f in REDUCED4]
    assert op.normalize(df).filter(F.col("total_amount") == 12.5).count() == 1


def test_a_named_table_is_never_named_by_position(spark):
    named = spark.createDataFrame(
        [("V1", "M1", "H1", 60.0, 2.0)],
        "vendor_id string, medallion string, license string, duration double, total double",
    )
    want = [("M1", "H1", 60.0, 2.0)]
    assert rows(op.conform(named).select(*REDUCED4.fieldNames())) == want
    assert rows(op.normalize(named)) == want


@pytest.mark.parametrize("rule", [op.conform, op.normalize])
def test_an_unknown_first_name_changes_nothing(spark, rule):
    named = spark.createDataFrame(
        [("T1", "M1", "H1", 60.0, 2.0)],
        "trip_id string, medallion string, hack_license string, trip_time_in_secs double, total_amount double",
    )
    assert rows(rule(named).select("medallion", "hack_license")) == [("M1", "H1")]


def test_widths_that_disagree_are_an_error(spark):
    lines = spark.createDataFrame([("a,b,c",), ("d,e,f",), ("g",)], "value string")
    assert op.settled_width(op.line_widths(lines)) == 3
    wide = lines.union(spark.createDataFrame([("a,b,c,d",)], "value string"))
    with pytest.raises(ValueError, match="disagree in width, 4 at most, most often 3"):
        op.settled_width(op.line_widths(wide))
    assert op.settled_width(op.line_widths(lines.limit(0))) is None


@pytest.mark.parametrize("width", [1, 6, 16, 18, 19, 25])
def test_unknown_names_at_no_layouts_width_are_an_error(spark, width):
    df = spark.sql("select " + ", ".join(f"'{i}' as field{i}" for i in range(width)))
    for rule in (op.conform, op.name_columns, op.restore_names):
        with pytest.raises(ValueError, match=f"none of the {width} columns.*field0.*has a known name"):
            rule(df)
    named = op.restore_names(df, positional=True)
    assert named.columns == TRIP17_NAMES[:width]


@pytest.mark.parametrize(("width", "layout"), [(17, "trip17"), (20, "classic20"), (21, "classic21")])
def test_unknown_names_at_a_layouts_width_are_that_layout(spark, width, layout):
    df = spark.sql("select " + ", ".join(f"'{i}' as field{i}" for i in range(width)))
    assert op.restore_names(df).columns == op.rename_layout(df, layout).columns != df.columns


@pytest.mark.parametrize(
    ("value", "fields"),
    [("", 1), ("a", 1), ("a,b", 2), (",", 2), ('"a,b",c', 2), ('"a""b,c",d', 2), ('a,"b,c', 2), ('"",""', 2), ('"', 1)],
)
def test_csv_fields(spark, value, fields):
    df = spark.createDataFrame([(value,)], "value string")
    assert df.select(op.csv_fields("value")).first()[0] == fields


def test_csv_fields_of_very_wide_records(spark):
    wide = [",".join(['"x,y"'] * n) for n in (20_000, 100_000)] + ['"' + "a," * 200_000]
    df = spark.createDataFrame([(w,) for w in wide], "value string")
    assert [r[0] for r in df.select(op.csv_fields("value")).collect()] == [20_000, 100_000, 1]

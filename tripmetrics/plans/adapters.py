"""Trips and trip lines derived from the driver tables, row for row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmetrics.schema import TRIP17, TRIP17_NAMES
from tripmetrics.sources import read_parquet

# What is wrong with a dirty trip, by the discount of its line item.
DIRT = {
    0.00: "seconds are no number",
    0.01: "license is empty",
    0.02: "distance is nan",
    0.03: "pickup is no date",
    0.04: "two fields only",
    0.05: "total is empty",
    0.06: "one field only",
    0.07: "seconds are zero",
    0.08: "distance is zero",
    0.09: "seconds are nan",
}
# And by its line number, where the discount is 0.10.
MORE_DIRT = {
    1: "seconds are inf",
    2: "total is inf",
    3: "total is -inf",
    4: "seconds are 1e400",
    5: "four fields too many",
    6: "surcharge is inf",
    7: "surcharge is no number",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """One trip17 row for each line item; suppliers stand for taxis, parts for drivers."""
    return _trip17(
        lineitem,
        medallion=F.concat(F.lit("M"), F.col("l_suppkey").cast("string")),
        hack_license=F.concat(F.lit("H"), F.col("l_partkey").cast("string")),
        pickup_datetime=F.col("l_shipdate"),
        dropoff_datetime=F.col("l_shipdate"),
        trip_time_in_secs=F.col("l_quantity") * 60,
        trip_distance=F.col("l_quantity"),
        payment_type=F.col("l_returnflag"),
        fare_amount=F.col("l_extendedprice"),
        surcharge=F.col("l_tax"),
        total_amount=F.col("l_extendedprice"),
    )


def trips_from_events(events: DataFrame, pickup: Column | None = None) -> DataFrame:
    """One trip17 row for each event, with pickups at every hour of the day."""
    return _trip17(
        events,
        medallion=F.concat(F.lit("M"), F.col("event_type")),
        hack_license=F.concat(F.lit("H"), F.col("user_id").cast("string")),
        pickup_datetime=F.col("ts") if pickup is None else pickup,
        trip_distance=F.col("value"),
        payment_type=F.col("event_type"),
        surcharge=F.get_json_object("props", "$.k").try_cast("double"),
        total_amount=F.col("value"),
    )


def _trip17(df: DataFrame, **known: Column) -> DataFrame:
    return df.select(
        *[
            known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
            for f in TRIP17
        ]
    )


def more_dirt(line: int) -> Column:
    return (F.col("l_discount") == 0.10) & (F.col("l_linenumber") == line)


def dirty_trip_columns(lineitem: DataFrame) -> dict[str, Column]:
    """The 17 text fields of a trip, spoiled by the discount rule above."""
    def spoiled(discount: float, bad: str, good: Column) -> Column:
        return F.when(F.col("l_discount") == discount, F.lit(bad)).otherwise(good)

    def spoiled_line(line: int, bad: str, good: Column) -> Column:
        return F.when(more_dirt(line), F.lit(bad)).otherwise(good)

    seconds = spoiled_line(
        1, "inf", spoiled_line(4, "1e400", (F.col("l_quantity") * 60).cast("string"))
    )
    total = spoiled_line(
        2, "inf", spoiled_line(3, "-inf", F.col("l_extendedprice").cast("string"))
    )
    distance = F.col("l_quantity").cast("string")
    day = F.col("l_shipdate").cast("string")
    fields = dict.fromkeys(TRIP17_NAMES, F.lit("0"))
    fields.update(
        medallion=F.concat(F.lit("M"), F.col("l_suppkey").cast("string")),
        hack_license=spoiled(0.01, "", F.concat(F.lit("H"), F.col("l_partkey").cast("string"))),
        pickup_datetime=spoiled(0.03, "not-a-date", day),
        dropoff_datetime=day,
        trip_time_in_secs=spoiled(
            0.0, "abc", spoiled(0.07, "0", spoiled(0.09, "nan", seconds))
        ),
        trip_distance=spoiled(0.02, "nan", spoiled(0.08, "0.0", distance)),
        payment_type=F.col("l_returnflag"),
        surcharge=spoiled_line(6, "inf", spoiled_line(7, "x", F.col("l_tax").cast("string"))),
        total_amount=spoiled(0.05, "", total),
    )
    return fields


def dirty_trip_lines(lineitem: DataFrame) -> DataFrame:
    """Dirty trips as comma text ``value``: most lines 17 fields wide, some two, one or 21."""
    fields = dirty_trip_columns(lineitem)
    cells = [fields[name] for name in TRIP17_NAMES]
    whole = F.concat_ws(",", *cells)
    return lineitem.select(
        F.when(F.col("l_discount") == 0.04, F.concat_ws(",", *cells[:2]))
        .when(F.col("l_discount") == 0.06, cells[0])
        .when(more_dirt(5), F.concat(whole, F.lit(",x,x,x,x")))
        .otherwise(whole)
        .alias("value")
    )


def header_text() -> str:
    return ",".join(TRIP17_NAMES)


def pickup_text() -> Column:
    """The time of an event in one of several written forms, by event type.

    click: ``Y-m-d H:M:S``; view: ``m/d/Y H:M:S``; error: ISO with ``T``;
    purchase: with a fraction of a second; others: between blanks.
    """
    stamp = F.substring(F.col("ts").cast("string"), 1, 19)
    day, clock = F.substring(stamp, 1, 10), F.substring(stamp, 12, 8)
    slashed = F.concat_ws(
        "/", F.substring(day, 6, 2), F.substring(day, 9, 2), F.substring(day, 1, 4)
    )
    return (
        F.when(F.col("event_type") == "click", stamp)
        .when(F.col("event_type") == "view", F.concat_ws(" ", slashed, clock))
        .when(F.col("event_type") == "error", F.concat_ws("T", day, clock))
        .when(F.col("event_type") == "purchase", F.concat(stamp, F.lit(".250000")))
        .otherwise(F.concat(F.lit("  "), stamp, F.lit(" ")))
    )


def event_trips_as_text(events: DataFrame) -> DataFrame:
    """Event trips with the pickup as text in several forms."""
    return trips_from_events(events, pickup_text())


def trip_lines(trips: DataFrame) -> DataFrame:
    """Any trip17 table as comma text ``value``, nulls as empty fields."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in TRIP17_NAMES]
    return trips.select(F.concat_ws(",", *cells).alias("value"))


def generic_columns(trips: DataFrame, names: list[str], width: int) -> DataFrame:
    """Trips as the nameless text table ``_c0 .. _cN`` in the order of ``names``.

    Columns a trip does not have, and those past the names, hold ``0``.
    """
    order = [*names, *["-"] * (width - len(names))]
    return trips.select(
        *[
            (F.col(n).cast("string") if n in TRIP17_NAMES else F.lit("0")).alias(f"_c{i}")
            for i, n in enumerate(order)
        ]
    )


def runs_from_orders(orders: DataFrame) -> DataFrame:
    """One run for each order status: its orders are the records, its keys the sizes."""
    return orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows_raw"),
        F.count_if(F.col("o_totalprice") > 100000).alias("records"),
        (F.sum("o_custkey") * 1000).alias("input_bytes"),
        (F.sum("o_orderkey").cast("double") / F.lit(100000.0)).alias("runtime_sec"),
        F.lit(6).alias("vcpus"),
    ).withColumnRenamed("o_orderstatus", "run_id")


def full_runs_from_orders(orders: DataFrame) -> DataFrame:
    """The same runs with every optional figure, named after it and the run."""
    names = ("task", "input_path", "staging", "output_json")
    return runs_from_orders(orders).withColumns(
        {name: F.concat(F.lit(f"{name} of "), F.col("run_id")) for name in names}
        | {
            "taxis_sec": F.col("rows_raw") / F.lit(1000.0),
            "drivers_sec": F.col("records") / F.lit(1000.0),
        }
    )

"""The three questions: best hour, top drivers, top taxis.

Every result is ordered by its measure, highest first, then by its key, so a
tie has one right answer. Trips with a null key take no part unless
``null_keys="keep"`` makes null a key like any other, last among equals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmetrics.functions import (
    clean_trip,
    event_hour,
    keys_present,
    minutes,
    num,
    number_or_null,
    positive,
    present,
    ratio,
)
from tripmetrics.operators.facts import COUNTS, record_counts, with_rejected
from tripmetrics.schema import SKETCH_RSD, SKETCH_SIZE, TRIP17_NAMES


def top(df: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the highest measure, ties by key."""
    return df.orderBy(F.desc(measure), F.asc_nulls_last(key)).limit(n)


# ------------------------------------------------------------------ best hour


def hourly_ratio(trips: DataFrame, pickup: str = "strict") -> DataFrame:
    """Mean of surcharge / distance over the trips of each pickup hour.

    It is a mean of ratios, not a ratio of sums. ``pickup`` names the rule for
    text times (see ``functions.times.PICKUP_RULES``).

    Only the distance is tested by a filter, which a columnar scan can use. Bad
    surcharges and times turn into nulls that the aggregate leaves out, so each
    of them is parsed once for each trip; as filters they would be parsed twice.
    """
    pickup_type = trips.schema["pickup_datetime"].dataType
    counted = F.col("hour").isNotNull() & F.col("ratio").isNotNull()
    return (
        trips.filter(positive(num("trip_distance")))
        .select(
            event_hour("pickup_datetime", pickup_type, pickup).alias("hour"),
            number_or_null(ratio(num("surcharge"), num("trip_distance"))).alias("ratio"),
        )
        .groupBy("hour")
        .agg(F.avg("ratio").alias("avg_ratio"), F.count_if(counted).alias("trips"))
        .filter((F.col("trips") > 0) & present("avg_ratio"))
    )


def best_hour(trips: DataFrame, pickup: str = "strict") -> DataFrame:
    """The hour with the highest mean ratio: one row, or none without valid trips."""
    return top(hourly_ratio(trips, pickup).select("hour", "avg_ratio"), "avg_ratio", "hour", 1)


# ---------------------------------------------------------------- top drivers


def _with_keys(trips: DataFrame, null_keys: str, *names: str) -> DataFrame:
    """``drop`` trips with a null key, or ``keep`` them under it."""
    if null_keys not in ("drop", "keep"):
        raise ValueError(f"unknown null_keys {null_keys!r}, expected 'drop' or 'keep'")
    return trips.filter(keys_present(*names)) if null_keys == "drop" else trips


def driver_rates(trips: DataFrame, null_keys: str = "drop") -> DataFrame:
    """Money, minutes and money per minute of each driver, over clean trips."""
    return (
        _with_keys(trips.filter(clean_trip()), null_keys, "hack_license")
        .groupBy("hack_license")
        .agg(
            F.sum(num("total_amount")).alias("money"),
            minutes(F.sum(num("trip_time_in_secs"))).alias("minutes"),
        )
        .filter(positive("minutes"))
        .withColumn("money_per_min", ratio("money", "minutes"))
        .filter(present("money_per_min"))
    )


def top_drivers(trips: DataFrame, n: int = 10, null_keys: str = "drop") -> DataFrame:
    """The ``n`` drivers with the most money per minute."""
    rates = driver_rates(trips, null_keys).select("hack_license", "money_per_min")
    return top(rates, "money_per_min", "hack_license", n)


# ------------------------------------------------------------------ top taxis


def in_scope(trips: DataFrame, scope: str) -> DataFrame:
    """``all`` trips, or only the ``clean`` ones."""
    if scope not in ("all", "clean"):
        raise ValueError(f"unknown scope {scope!r}, expected 'all' or 'clean'")
    return trips.filter(clean_trip()) if scope == "clean" else trips


def taxi_driver_pairs(
    trips: DataFrame, scope: str = "all", null_keys: str = "drop"
) -> DataFrame:
    """Each taxi with each of its drivers, once.

    Equal pairs meet in the map-side aggregate and what is left is spread by
    both keys, so a taxi that holds a large share of all trips is shared out
    over its drivers. A null driver is nobody, so only a null taxi can be kept.
    """
    return (
        _with_keys(in_scope(trips, scope), null_keys, "medallion")
        .filter(keys_present("hack_license"))
        .select("medallion", "hack_license")
        .distinct()
    )


def taxi_drivers(
    trips: DataFrame,
    method: str = "exact",
    scope: str = "all",
    rsd: float = SKETCH_RSD,
    null_keys: str = "drop",
) -> DataFrame:
    """Number of distinct drivers of each taxi.

    ``exact`` shuffles the distinct pairs. ``approx`` shuffles one sketch for
    each taxi and map task instead, with relative standard deviation ``rsd``:
    the choice when nearly every trip is a new pair.
    """
    if method == "exact":
        return (
            taxi_driver_pairs(trips, scope, null_keys)
            .groupBy("medallion")
            .agg(F.count(F.lit(1)).alias("num_drivers"))
        )
    if method == "approx":
        return (
            _with_keys(in_scope(trips, scope), null_keys, "medallion")
            .filter(keys_present("hack_license"))
            .groupBy("medallion")
            .agg(F.approx_count_distinct("hack_license", rsd).alias("num_drivers"))
        )
    raise ValueError(f"unknown method {method!r}, expected 'exact' or 'approx'")


def top_taxis(
    trips: DataFrame,
    n: int = 10,
    method: str = "exact",
    scope: str = "all",
    rsd: float = SKETCH_RSD,
    null_keys: str = "drop",
) -> DataFrame:
    """The ``n`` taxis with the most distinct drivers."""
    counts = taxi_drivers(trips, method, scope, rsd, null_keys)
    return top(counts, "num_drivers", "medallion", n)


def sketch_error(trips: DataFrame, scope: str = "all", rsd: float = SKETCH_RSD) -> DataFrame:
    """Exact and approximate driver count of each taxi and their relative difference.

    The sketch is fed with the distinct pairs, which changes nothing about it
    (repeats never do) and lets one pass give both counts.
    """
    return (
        taxi_driver_pairs(trips, scope)
        .groupBy("medallion")
        .agg(
            F.count(F.lit(1)).alias("exact"),
            F.approx_count_distinct("hack_license", rsd).alias("approx"),
        )
        .withColumn(
            "error", F.try_divide(F.abs(F.col("approx") - F.col("exact")), F.col("exact"))
        )
    )


# ----------------------------------------------------------- stored sketches


def taxi_sketches(
    trips: DataFrame, scope: str = "all", size: int = SKETCH_SIZE, null_keys: str = "drop"
) -> DataFrame:
    """One HyperLogLog sketch of its drivers for each taxi, in ``drivers``.

    Sketches of several batches of trips are kept (``sinks.write_sketches``) and merged
    later, so a new batch never needs the trips of an old one. ``size`` is the logarithm
    of the registers; only sketches of one size should be merged.
    """
    return (
        _with_keys(in_scope(trips, scope), null_keys, "medallion")
        .filter(keys_present("hack_license"))
        .groupBy("medallion")
        .agg(F.hll_sketch_agg("hack_license", size).alias("drivers"))
    )


def merged_taxi_drivers(sketches: DataFrame) -> DataFrame:
    """Distinct drivers of each taxi, estimated from all its sketches.

    A taxi that was driven in every batch has one sketch for each, merged before the
    shuffle where they lie together, so what moves is a sketch for each taxi and task.
    """
    return sketches.groupBy("medallion").agg(
        F.hll_sketch_estimate(F.hll_union_agg("drivers")).alias("num_drivers")
    )


def top_taxis_merged(sketches: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` taxis with the most drivers, from stored sketches alone."""
    return top(merged_taxi_drivers(sketches), "num_drivers", "medallion", n)


def sketch_bound(size: int = SKETCH_SIZE) -> float:
    """Relative standard deviation of a merged sketch of 2 to the power ``size`` registers."""
    return 1.04 / (1 << size) ** 0.5


def ranking_check(exact: DataFrame, ranking: DataFrame, bound: float) -> DataFrame:
    """How an approximate ranking of taxis stands against the exact counts of all taxis, in one row.

    ``taxis`` in all, ``ranked`` places, ``off``: ranked taxis whose count is off by more than
    ``bound`` (a share of the exact count), and ``missed``: whether a taxi outside the ranking
    is above its last place by more than the bound. Counts and places meet by grouping,
    so neither side is broadcast.
    """
    both = exact.select("medallion", F.col("num_drivers").alias("exact"), F.lit(None).cast("long").alias("approx")).unionByName(
        ranking.select("medallion", F.lit(None).cast("long").alias("exact"), F.col("num_drivers").alias("approx"))
    )
    taxis = both.groupBy("medallion").agg(F.max("exact").alias("exact"), F.max("approx").alias("approx"))
    ranked = F.col("approx").isNotNull()
    off = F.abs(F.col("approx") - F.coalesce("exact", F.lit(0))) > bound * F.coalesce("exact", F.lit(0))
    return taxis.agg(
        F.count("exact").alias("taxis"),
        F.count_if(ranked).alias("ranked"),
        F.count_if(ranked & off).alias("off"),
        F.coalesce(
            F.max(F.when(~ranked, F.col("exact"))) * (1 - bound) > F.min("approx"), F.lit(False)
        ).alias("missed"),
    )


# ------------------------------------------------- rankings with their row counts


def counted_ranking(
    trips: DataFrame,
    question: str,
    n: int = 10,
    method: str = "exact",
    scope: str = "all",
    rsd: float = SKETCH_RSD,
    null_keys: str = "drop",
    width: int = len(TRIP17_NAMES),
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The grouped table of one question, and the ranking as a function of it.

    The groups also hold ``rows_raw`` and ``rows_kept``, so that a job which needs both the
    ranking and the row counts reads its input once and holds no more than the groups:
    drivers, taxis, or for exact counts their pairs. ``grouped_facts`` adds the counts up.
    Records that were shorter or wider than ``width`` are counted too, where the rows tell.
    """
    clean = clean_trip()
    counts = record_counts(trips, clean, width)
    if question == "top_drivers":
        groups = trips.groupBy("hack_license").agg(
            *counts,
            F.sum(F.when(clean, num("total_amount"))).alias("total_amount"),
            F.sum(F.when(clean, num("trip_time_in_secs"))).alias("trip_time_in_secs"),
        )
        # A driver's sums are one clean trip or none, so the same rules rank them.
        return groups, lambda held: top_drivers(held, n, null_keys)
    if question != "top_taxis":
        raise ValueError(f"no counted ranking for {question!r}")
    in_scope(trips, scope)  # refuses an unknown scope
    used = F.lit(True) if scope == "all" else clean
    if method == "exact":
        groups = trips.groupBy("medallion", "hack_license").agg(
            *counts, F.max(F.coalesce(used, F.lit(False))).alias("used")
        )
        return groups, lambda held: top_taxis(held.filter("used"), n, null_keys=null_keys)
    if method != "approx":
        raise ValueError(f"unknown method {method!r}, expected 'exact' or 'approx'")
    driver = F.when(used, F.col("hack_license"))
    groups = trips.groupBy("medallion").agg(
        *counts, F.approx_count_distinct(driver, rsd).alias("num_drivers")
    )

    def ranking(held: DataFrame) -> DataFrame:
        found = _with_keys(held.filter("num_drivers > 0"), null_keys, "medallion")
        return top(found.select("medallion", "num_drivers"), "num_drivers", "medallion", n)

    return groups, ranking


def grouped_facts(groups: DataFrame) -> DataFrame:
    """The facts of a run, from groups that hold its counts."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS if c in groups.columns]
    return with_rejected(groups.agg(*sums))


# -------------------------------------------------------------- both rankings


def both_rankings(trips: DataFrame, n: int = 10) -> DataFrame:
    """Top drivers and top taxis (exact) over the clean trips in one pass.

    Trips are reduced to one row for each taxi and driver, the shuffle the exact
    distinct count needs in any case. Both questions group those rows, so the input
    is read and shuffled once and nothing has to be cached: the second question reads
    the shuffle of the first. Each ranking is then a heap of ``n`` rows in every task,
    and only those rows meet, so at any ``n`` no task sorts all drivers.

    Columns: ``ranking`` (``top_drivers`` or ``top_taxis``), ``place``, ``key``,
    ``measure``.
    """
    pairs = (
        trips.filter(clean_trip() & keys_present("hack_license"))
        .groupBy("medallion", "hack_license")
        .agg(
            F.sum(num("total_amount")).alias("money"),
            F.sum(num("trip_time_in_secs")).alias("secs"),
        )
    )
    # Both sums are there in every pair. Counting them, not the rows, leaves both questions with
    # the same columns of the pairs, and so with one shuffle: pruned apart they would have two.
    taxis = pairs.groupBy("medallion").agg(
        F.count(F.col("money") + F.col("secs")).cast("double").alias("measure")
    )
    drivers = (
        pairs.groupBy("hack_license")
        .agg(F.sum("money").alias("money"), F.sum("secs").alias("secs"))
        .withColumn("measure", ratio("money", minutes("secs")))
        .filter(present("measure"))
    )
    return _places(drivers, "top_drivers", "hack_license", n).unionByName(
        _places(taxis, "top_taxis", "medallion", n)
    )


def _places(measures: DataFrame, ranking: str, key: str, n: int) -> DataFrame:
    """The first ``n`` keys with their places.

    A null key is left out after the heap, which has room for it: as a filter before, it would
    be pushed down to one reader of the pairs and cost the other its shuffle.
    """
    best_first = W.orderBy(F.desc("measure"), F.asc_nulls_last("key"))
    first = top(measures.select(F.col(key).alias("key"), "measure"), "measure", "key", n + 1)
    return (
        first.filter(keys_present("key"))
        .withColumn("place", F.row_number().over(best_first))  # n + 1 rows, already in order
        .filter(F.col("place") <= n)
        .select(F.lit(ranking).alias("ranking"), "place", "key", "measure")
    )


def both_rankings_shared(
    trips: DataFrame,
    n: int = 10,
    method: str = "approx",
    rsd: float = SKETCH_RSD,
) -> dict[str, DataFrame]:
    """The two rankings as two tables over the same clean trips.

    Read the result inside ``held(trips)`` when the input is costly to parse, so
    that it is parsed once; over Parquet two pruned scans are cheaper than a cache.
    """
    return {
        "top_taxis": top_taxis(trips, n, method, "clean", rsd),
        "top_drivers": top_drivers(trips, n),
    }

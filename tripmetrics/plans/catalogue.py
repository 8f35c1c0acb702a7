"""Every query by name, over the driver tables. ``oracles.py`` has the SQL for each."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmetrics import operators as op
from tripmetrics import sinks, sources
from tripmetrics.functions import clean_trip, num, positive, present, text
from tripmetrics.plans import adapters as ad
from tripmetrics.plans import jobs
from tripmetrics.schema import LAYOUTS, REQUIRED, SKETCH_RSD, TRIP17_NAMES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ------------------------------------------------------------------ inputs


def lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return ad.table(spark, sf, "lineitem")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return ad.table(spark, sf, "events")


def lineitem_trips(spark: SparkSession, sf: str) -> DataFrame:
    return ad.trips_from_lineitem(lineitem(spark, sf))


def event_trips(spark: SparkSession, sf: str) -> DataFrame:
    return ad.trips_from_events(events(spark, sf))


def dirty_lines(spark: SparkSession, sf: str) -> DataFrame:
    return ad.dirty_trip_lines(lineitem(spark, sf))


def dirty_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Dirty lines through the line loader, typed as trip17."""
    columns = op.lines_to_columns(dirty_lines(spark, sf), len(TRIP17_NAMES), blank_as_null=True)
    return op.conform(columns)


def text_file(spark: SparkSession, lines: DataFrame, name: str) -> str:
    """Lines written as text files in the scratch folder."""
    path = sources.scratch_path(spark, name)
    lines.write.text(path)
    return path


def with_header(lines: DataFrame) -> DataFrame:
    """The same lines after a header line, which lands in the first part."""
    first = lines.sparkSession.range(0, 1, 1, 1).select(F.lit(ad.header_text()).alias("value"))
    return first.union(lines)


# --------------------------------------------------------------- best hour


def hours(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_ratio", F.round("avg_ratio", 6))


@query
def best_hour(spark: SparkSession, sf: str) -> DataFrame:
    return hours(op.best_hour(event_trips(spark, sf)))


@query
def hourly_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return hours(op.hourly_ratio(event_trips(spark, sf)))


@query
def best_hour_multi_format(spark: SparkSession, sf: str) -> DataFrame:
    return hours(op.best_hour(ad.event_trips_as_text(events(spark, sf)), "multi"))


@query
def hourly_ratio_multi_format(spark: SparkSession, sf: str) -> DataFrame:
    return hours(op.hourly_ratio(ad.event_trips_as_text(events(spark, sf)), "multi"))


@query
def hourly_ratio_cut_text(spark: SparkSession, sf: str) -> DataFrame:
    return hours(op.hourly_ratio(ad.event_trips_as_text(events(spark, sf)), "cut"))


@query
def hourly_ratio_strict_lines(spark: SparkSession, sf: str) -> DataFrame:
    """From comma text through the line loader; only the strict time form counts."""
    lines = ad.trip_lines(ad.event_trips_as_text(events(spark, sf)))
    return hours(op.hourly_ratio(op.conform(op.lines_to_columns(lines, len(TRIP17_NAMES)))))


@query
def best_hour_empty(spark: SparkSession, sf: str) -> DataFrame:
    return hours(op.best_hour(event_trips(spark, sf).filter(F.col("trip_distance") < 0)))


# ------------------------------------------------------------- top drivers


def rates(df: DataFrame) -> DataFrame:
    return df.withColumn("money_per_min", F.round("money_per_min", 6))


@query
def top_drivers(spark: SparkSession, sf: str) -> DataFrame:
    return rates(op.top_drivers(lineitem_trips(spark, sf)))


@query
def driver_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Money and time as whole cents and seconds: no exact half is left to round either way."""
    return op.driver_rates(lineitem_trips(spark, sf)).select(
        "hack_license",
        F.round(F.col("money") * 100).cast("long").alias("cents"),
        F.round(F.col("minutes") * 60).cast("long").alias("seconds"),
        F.round("money_per_min", 9).alias("money_per_min"),
    )


@query
def top_drivers_dirty_lines(spark: SparkSession, sf: str) -> DataFrame:
    """From comma text with every kind of bad line."""
    return rates(op.top_drivers(dirty_trips(spark, sf)))


# --------------------------------------------------------------- top taxis


@query
def top_taxis_exact(spark: SparkSession, sf: str) -> DataFrame:
    return op.top_taxis(lineitem_trips(spark, sf))


@query
def taxi_drivers_exact(spark: SparkSession, sf: str) -> DataFrame:
    return op.taxi_drivers(lineitem_trips(spark, sf))


@query
def top_taxis_clean_scope(spark: SparkSession, sf: str) -> DataFrame:
    return op.top_taxis(dirty_trips(spark, sf), scope="clean")


@query
def top_taxis_dirty_lines(spark: SparkSession, sf: str) -> DataFrame:
    return op.top_taxis(dirty_trips(spark, sf), scope="all")


@query
def top_taxis_approx(spark: SparkSession, sf: str) -> DataFrame:
    return op.top_taxis(lineitem_trips(spark, sf), method="approx", scope="clean")


@query
def approx_error_bound(spark: SparkSession, sf: str) -> DataFrame:
    """Taxis, and those whose sketch is off by more than four standard deviations."""
    return op.sketch_error(lineitem_trips(spark, sf)).agg(
        F.count(F.lit(1)).alias("taxis"),
        F.count_if(F.col("error") > 4 * SKETCH_RSD).alias("beyond"),
    )


@query
def taxi_driver_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return op.taxi_driver_pairs(lineitem_trips(spark, sf))


# ------------------------------------------------------------ both rankings


@query
def both_rankings(spark: SparkSession, sf: str) -> DataFrame:
    """One pass over the trips."""
    return op.both_rankings(lineitem_trips(spark, sf)).withColumn("measure", F.round("measure", 6))


@query
def both_rankings_two_tables(spark: SparkSession, sf: str) -> DataFrame:
    """As two tables over the same clean trips, put under one another."""
    tables = op.both_rankings_shared(lineitem_trips(spark, sf), method="exact")
    return both_tables(tables["top_taxis"], tables["top_drivers"])


# -------------------------------------------------------------- text lines


@query
def lines_to_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Written as text files, read back without the header, width measured."""
    path = text_file(spark, with_header(dirty_lines(spark, sf)), "lines")
    return op.lines_to_columns(sources.read_lines(spark, path, header=True))


@query
def two_field_lines(spark: SparkSession, sf: str) -> DataFrame:
    kept = op.two_field_lines(dirty_lines(spark, sf))
    return kept.groupBy(F.size("parts").alias("fields")).agg(F.count(F.lit(1)).alias("lines"))


@query
def widest_line(spark: SparkSession, sf: str) -> DataFrame:
    return op.widest_line(dirty_lines(spark, sf))


@query
def line_facts(spark: SparkSession, sf: str) -> DataFrame:
    return op.line_facts(dirty_lines(spark, sf))


@query
def parse_numbers(spark: SparkSession, sf: str) -> DataFrame:
    cells = ad.dirty_trip_columns(lineitem(spark, sf))
    dirty = lineitem(spark, sf).select(
        "l_orderkey", "l_linenumber", *[c.alias(n) for n, c in cells.items()]
    )
    parsed = dirty.select(
        text("l_orderkey").alias("order_text"),
        "l_linenumber",
        num("trip_time_in_secs").alias("secs"),
        num("trip_distance").alias("distance"),
        num("total_amount").alias("total"),
    )
    return parsed.filter(present("secs") & positive("distance") & present("total"))


# ----------------------------------------------------------- names and types


def by_layout(spark: SparkSession, sf: str, layout: str, hint: str | None) -> DataFrame:
    names, width = LAYOUTS[layout]
    return op.normalize(ad.generic_columns(lineitem_trips(spark, sf), names, width), hint)


@query
def layout_trip17(spark: SparkSession, sf: str) -> DataFrame:
    return by_layout(spark, sf, "trip17", None)


@query
def layout_classic21(spark: SparkSession, sf: str) -> DataFrame:
    return by_layout(spark, sf, "classic21", None)


@query
def layout_classic20(spark: SparkSession, sf: str) -> DataFrame:
    return by_layout(spark, sf, "classic20", None)


@query
def layout_classic17(spark: SparkSession, sf: str) -> DataFrame:
    return by_layout(spark, sf, "classic17", "classic17")


@query
def alias_columns(spark: SparkSession, sf: str) -> DataFrame:
    trips = lineitem_trips(spark, sf)
    renamed = trips.select(
        F.col("medallion").alias("Taxi_ID"),
        F.col("hack_license").alias("Driver_ID"),
        F.col("trip_time_in_secs").alias("Duration"),
        F.col("total_amount").alias("TOTAL"),
        "payment_type",
    )
    return op.normalize(renamed)


@query
def conform_missing(spark: SparkSession, sf: str) -> DataFrame:
    """The first six columns without names: named by position, the rest typed nulls."""
    trips = ad.generic_columns(lineitem_trips(spark, sf), TRIP17_NAMES[:6], 6)
    return op.conform(trips, positional=True)


@query
def conform_extra(spark: SparkSession, sf: str) -> DataFrame:
    """Nineteen columns with lost names: the last two are dropped."""
    trips = ad.generic_columns(lineitem_trips(spark, sf), TRIP17_NAMES, 19)
    lost = trips.toDF(*[f"field{i}" for i in range(19)])
    return op.conform(lost, positional=True).select(*REQUIRED, "trip_distance", "surcharge")


@query
def preview(spark: SparkSession, sf: str) -> DataFrame:
    return op.preview(op.normalize(lineitem_trips(spark, sf)), *REQUIRED)


# -------------------------------------------------------- sources and sinks


@query
def csv_permissive(spark: SparkSession, sf: str) -> DataFrame:
    path = text_file(spark, dirty_lines(spark, sf), "csv")
    return sources.read_csv_permissive(spark, path, len(TRIP17_NAMES))


@query
def csv_drop_malformed(spark: SparkSession, sf: str) -> DataFrame:
    path = text_file(spark, dirty_lines(spark, sf), "csv")
    records = sources.read_csv(
        spark, path, header=False, schema=sources.generic_schema(len(TRIP17_NAMES))
    )
    return op.normalize(records).filter(clean_trip())


@query
def csv_quality(spark: SparkSession, sf: str) -> DataFrame:
    path = text_file(spark, dirty_lines(spark, sf), "csv")
    schema = sources.generic_schema(len(TRIP17_NAMES))
    return sources.csv_quality(spark, path, schema, header=False)


@query
def csv_header_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """Quoted fields under a header, types inferred."""
    path = sources.scratch_path(spark, "csv-quoted")
    trips = lineitem_trips(spark, sf).select(
        F.concat_ws(",", "medallion", "payment_type").alias("medallion"),
        *REQUIRED[1:],
    )
    trips.write.option("header", True).option("quoteAll", True).csv(path)
    return op.normalize(sources.read_csv(spark, path, header=True, infer=True))


@query
def read_by_format(spark: SparkSession, sf: str) -> DataFrame:
    """The same trips through every reader, told apart by ``fmt``."""
    trips = lineitem_trips(spark, sf)
    text_path = text_file(spark, ad.trip_lines(trips), "by-format-text")
    parquet_path = sinks.stage_parquet(trips, sources.scratch_path(spark, "by-format-parquet"))
    found = None
    for fmt in ("parquet", "csv", "csv_permissive", "lines"):
        path = parquet_path if fmt == "parquet" else text_path
        layout = None if fmt == "parquet" else "trip17"
        part = (
            op.normalize(sources.read_trips(spark, path, fmt, header=False, layout=layout))
            .groupBy("medallion")
            .agg(
                F.count(F.lit(1)).alias("trips"),
                F.round(F.sum("total_amount"), 2).alias("money"),
            )
            .select(F.lit(fmt).alias("fmt"), "medallion", "trips", "money")
        )
        found = part if found is None else found.unionByName(part)
    return found


@query
def stage_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """Dirty CSV, typed and staged as Parquet, read back."""
    csv = text_file(spark, dirty_lines(spark, sf), "stage-csv")
    records = sources.read_csv_permissive(spark, csv, len(TRIP17_NAMES))
    out = sinks.staging_path(sources.scratch_path(spark, "stage"))
    return staged_counts(sources.read_staged(spark, sinks.stage_parquet(op.conform(records), out)))


def staged_counts(staged: DataFrame) -> DataFrame:
    clean = clean_trip()
    return staged.groupBy("medallion").agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(clean).alias("clean_trips"),
        F.count("hack_license").alias("licenses"),
        F.round(F.sum(F.when(clean, F.col("total_amount"))), 2).alias("money"),
    )


@query
def stage_parquet_sized(spark: SparkSession, sf: str) -> DataFrame:
    """Dirty lines staged as files of one size."""
    staging = sources.scratch_path(spark, "stage-sized")
    csv = text_file(spark, dirty_lines(spark, sf), "stage-csv")
    return staged_counts(jobs.stage(spark, csv, staging, layout="trip17", file_bytes=256 * 1024))


@query
def stage_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Two halves of the days, staged one after the other, and the second once more."""
    staging = sources.scratch_path(spark, "stage-days")
    found, late = events(spark, sf), F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    for batch, half in (("early", ~late), ("late", late), ("late", late)):
        lines = ad.trip_lines(ad.event_trips_as_text(found.filter(half)))
        csv = text_file(spark, lines, f"days-{batch}")
        staged = jobs.stage(spark, csv, staging, layout="trip17", by_day=True, batch=batch)
    return hours(op.hourly_ratio(staged, "multi"))


@query
def read_staged_days(spark: SparkSession, sf: str) -> DataFrame:
    """Three days of a set that is kept by day; the other days' folders are not opened."""
    staging = sources.scratch_path(spark, "stage-days")
    sinks.stage_days(op.conform(ad.event_trips_as_text(events(spark, sf))), staging)
    staged = sources.read_staged(spark, staging, days=("2024-01-10", "2024-01-12"))
    return hours(op.hourly_ratio(staged, "multi"))


@query
def ranking_json(spark: SparkSession, sf: str) -> DataFrame:
    ranking = op.top_drivers(lineitem_trips(spark, sf))
    out = sinks.write_ranking_json(ranking, sources.scratch_path(spark, "ranking"))
    return rates(spark.read.schema(ranking.schema).json(out))


# ---------------------------------------------------------------- run facts


@query
def run_facts(spark: SparkSession, sf: str) -> DataFrame:
    return op.run_facts(dirty_trips(spark, sf))


@query
def input_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Files and bytes of a set that was just written: a folder and a file for each return flag."""
    path = sources.scratch_path(spark, "folders")
    lines = lineitem(spark, sf).select("l_returnflag", F.format_string("%020d", "l_orderkey").alias("value"))
    sinks.write_text_folders(lines.repartition("l_returnflag"), path, "l_returnflag")
    size = op.input_bytes(sources.input_folders(spark, path))
    return size.select("files", "input_bytes", F.round("input_gb", 9).alias("input_gb"))


@query
def input_bytes_text(spark: SparkSession, sf: str) -> DataFrame:
    """Size of text just written: its characters and one line end for each line."""
    path = text_file(spark, dirty_lines(spark, sf), "bytes")
    size = op.input_bytes(sources.input_folders(spark, path))
    return size.select("input_bytes", F.round("input_gb", 9).alias("input_gb"))


@query
def input_bytes_by_folder(spark: SparkSession, sf: str) -> DataFrame:
    """The listing itself: bytes of each month of a partitioned text set."""
    path = sources.scratch_path(spark, "months")
    month = F.date_format("l_shipdate", "yyyyMM").alias("month")
    lines = lineitem(spark, sf).select(month, F.col("l_orderkey").cast("string").alias("value"))
    sinks.write_text_folders(lines.repartition("month"), path, "month")
    folders = sources.input_folders(spark, path)
    return folders.select(F.substring_index("folder", "=", -1).alias("month"), "files", "bytes")


@query
def run_economics(spark: SparkSession, sf: str) -> DataFrame:
    found = op.economics(ad.runs_from_orders(ad.table(spark, sf, "orders")))
    digits = {
        "vcpu_minutes": 4,
        "cost_usd": 6,
        "input_gb": 6,
        "records_per_sec": 4,
        "cost_per_gb": 6,
        "cost_per_record": 10,
        "records_per_usd": 2,
    }
    return found.select(
        "run_id", "rows_raw", "records", *[F.round(c, d).alias(c) for c, d in digits.items()]
    )


def reports(spark: SparkSession, sf: str, style: str) -> DataFrame:
    """The report of every run as text lines, written and read back."""
    runs = op.economics(ad.full_runs_from_orders(ad.table(spark, sf, "orders")))
    out = sources.scratch_path(spark, "summary")
    return spark.read.text(sinks.write_summary_text(op.summary(runs, style), out))


@query
def summary_text(spark: SparkSession, sf: str) -> DataFrame:
    return reports(spark, sf, "economic")


@query
def summary_combined(spark: SparkSession, sf: str) -> DataFrame:
    return reports(spark, sf, "combined")


@query
def summary_short(spark: SparkSession, sf: str) -> DataFrame:
    return reports(spark, sf, "short")


@query
def summary_staged(spark: SparkSession, sf: str) -> DataFrame:
    return reports(spark, sf, "staged")


# --------------------------------------------------------------- whole jobs


def dirty_file(spark: SparkSession, sf: str) -> str:
    return text_file(spark, with_header(dirty_lines(spark, sf)), "job-in")


def both_tables(taxis: DataFrame, drivers: DataFrame) -> DataFrame:
    """The two rankings under one another as ``ranking``, ``key``, ``measure``."""
    return taxis.select(
        F.lit("top_taxis").alias("ranking"),
        F.col("medallion").alias("key"),
        F.col("num_drivers").cast("double").alias("measure"),
    ).unionByName(
        drivers.select(
            F.lit("top_drivers").alias("ranking"),
            F.col("hack_license").alias("key"),
            F.round("money_per_min", 6).alias("measure"),
        )
    )


@query
def job_both_rankings(spark: SparkSession, sf: str) -> DataFrame:
    """Text in, two JSON rankings out of one cached table, read back."""
    out = sources.scratch_path(spark, "job-both")
    written = jobs.run(
        spark, "both", dirty_file(spark, sf), out, layout="trip17", scope="clean", style="combined"
    )
    return both_tables(
        spark.read.schema("medallion string, num_drivers long").json(written["top_taxis"]),
        spark.read.schema("hack_license string, money_per_min double").json(written["top_drivers"]),
    )


@query
def job_staged_drivers(spark: SparkSession, sf: str) -> DataFrame:
    """CSV in, staged as Parquet, one JSON ranking out, read back."""
    out = sources.scratch_path(spark, "job-staged")
    path = text_file(spark, dirty_lines(spark, sf), "job-in")
    written = jobs.run(
        spark, "top_drivers", path, out, fmt="csv_permissive", header=False, layout="trip17",
        staged=True, style="staged",
    )
    ranking = spark.read.schema("hack_license string, money_per_min double")
    return rates(ranking.json(written["top_drivers"]))


@query
def job_best_hour_report(spark: SparkSession, sf: str) -> DataFrame:
    """Text in, the report out: its lines on the result and on the number of records."""
    lines = with_header(ad.trip_lines(ad.event_trips_as_text(events(spark, sf))))
    written = jobs.run(
        spark, "best_hour", text_file(spark, lines, "job-in"),
        sources.scratch_path(spark, "job-hour"), layout="trip17", pickup="multi",
    )
    report = spark.read.text(written["summary"])
    return report.filter(F.col("value").rlike("^\\('(Best Hour|Average Ratio|Total Records)'"))


# ------------------------------------------------- odd inputs, bounds, null keys


def odd_first(spark: SparkSession, lines: DataFrame, odd: Column, name: str) -> str:
    """Lines as text files, the odd ones in a folder of their own (``part``) that comes first.

    Written in one pass: as filters of two, ``odd`` would have each line made anew for every look at it.
    """
    part = F.when(odd, "a").otherwise("b").alias("part")
    return sinks.write_text_folders(lines.select("value", part), sources.scratch_path(spark, name), "part")


def trips_and_clean(trips: DataFrame) -> DataFrame:
    return trips.groupBy("medallion").agg(
        F.count(F.lit(1)).alias("trips"), F.count_if(clean_trip()).alias("clean_trips")
    )


@query
def hourly_ratio_dirty_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Bad and endless distances, surcharges and times, from text."""
    return hours(op.hourly_ratio(dirty_trips(spark, sf)))


@query
def csv_first_record_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Malformed records are dropped, the first as any other; the layout gives the width.

    Short records are padded before, so that only wide ones are malformed.
    """
    cells = F.size(F.split("value", ","))
    padding = F.repeat(F.lit(","), F.greatest(F.lit(0), len(TRIP17_NAMES) - cells))
    lines = dirty_lines(spark, sf).select(F.concat("value", padding).alias("value"))
    path = odd_first(spark, lines, cells > len(TRIP17_NAMES), "csv-wide")
    records = sources.read_trips(spark, path, "csv", header=False, layout="trip17")
    return trips_and_clean(op.conform(op.name_columns(records.drop("part"))))


@query
def csv_first_record_short(spark: SparkSession, sf: str) -> DataFrame:
    """Every record is kept; a first one of a single field narrows none of them."""
    short = F.size(F.split("value", ",")) == 1
    path = odd_first(spark, dirty_lines(spark, sf), short, "csv-short")
    records = sources.read_trips(spark, path, "csv_permissive", header=False, layout="trip17")
    return trips_and_clean(op.conform(op.name_columns(records.drop("part"))))


@query
def lines_one_wide_line(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with stray fields, which would look like another layout, under a hint."""
    path = text_file(spark, dirty_lines(spark, sf), "lines-wide")
    trips = sources.read_trips(spark, path, "lines", header=False, layout="trip17")
    return rates(op.top_drivers(op.normalize(trips, "trip17")))


@query
def conform_unknown_first_name(spark: SparkSession, sf: str) -> DataFrame:
    """A named table keeps its names, whatever comes first."""
    trips = lineitem_trips(spark, sf).select(
        F.lit("T").alias("trip_id"), "trip_distance", F.col("hack_license").alias("Driver_ID"),
        "medallion", "trip_time_in_secs", "total_amount",
    )
    return op.conform(trips).select(*REQUIRED, "trip_distance")


def rejects_of(spark: SparkSession, written: dict[str, str]) -> DataFrame:
    names = (
        "rows_raw", "rows_kept", "rows_rejected", "records_read", "short_records",
        "wide_records", "extra_columns",
    )
    schema = ", ".join(f"{name} long" for name in names)
    return spark.read.schema(schema).json(written["rejects"])


@query
def job_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """What a job over dirty text left out, padded and cut."""
    written = jobs.run(
        spark, "top_drivers", dirty_file(spark, sf), sources.scratch_path(spark, "job-rejects"),
        layout="trip17", style="short", rejects=True,
    )
    return rejects_of(spark, written)


def csv_with_headers(spark: SparkSession, lines: DataFrame, name: str) -> str:
    """Lines as files that each begin with the header."""
    path = sources.scratch_path(spark, name)
    plain = {"header": True, "sep": "\u0001", "quote": "\u0000", "escapeQuotes": False}
    lines.select(F.col("value").alias(ad.header_text())).write.options(**plain).csv(path)
    return path


@query
def job_rejects_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The same from CSV files with headers, whose malformed records are dropped but counted."""
    path = csv_with_headers(spark, dirty_lines(spark, sf), "csv-headers")
    written = jobs.run(
        spark, "both", path, sources.scratch_path(spark, "job-rejects-csv"), fmt="csv", header=True,
        scope="clean", style="combined", rejects=True,
    )
    return rejects_of(spark, written)


@query
def job_rejects_staged(spark: SparkSession, sf: str) -> DataFrame:
    """The same through a staging set, which carries what each record was."""
    path = csv_with_headers(spark, dirty_lines(spark, sf), "csv-headers")
    written = jobs.run(
        spark, "top_taxis", path, sources.scratch_path(spark, "job-rejects-staged"), fmt="csv_permissive",
        header=True, staged=True, style="staged", rejects=True,
    )
    return rejects_of(spark, written)


@query
def csv_many_quoted_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Records of 800 to 20,000 quoted fields, each with a comma inside: how many have how many fields."""
    fields = (F.col("s_nationkey") + 1) * 800
    line = F.concat(F.repeat(F.lit('"a,b",'), (fields - 1).cast("int")), F.lit('"a,b"'))
    suppliers = ad.table(spark, sf, "supplier").select(line.alias("value"))
    return sources.record_widths(spark, text_file(spark, suppliers, "csv-many"))


def within_bound(exact: DataFrame, approx: DataFrame, key: str, rsd: float = SKETCH_RSD) -> DataFrame:
    """Exact counts, and whether the sketch is within four standard deviations of them."""
    both = exact.select(key, "num_drivers", F.lit(0).alias("sketch")).unionByName(
        approx.select(key, F.lit(0).alias("num_drivers"), F.col("num_drivers").alias("sketch"))
    )
    summed = both.groupBy(key).agg(
        F.sum("num_drivers").alias("num_drivers"), F.sum("sketch").alias("sketch")
    )
    off = F.abs(F.col("sketch") - F.col("num_drivers"))
    return summed.select(
        key, "num_drivers", (off <= 4 * rsd * F.col("num_drivers")).alias("within_bound")
    )


@query
def taxi_drivers_within_bound(spark: SparkSession, sf: str) -> DataFrame:
    """The approximate count of every taxi over clean trips beside the exact one."""
    trips = dirty_trips(spark, sf)
    exact = op.taxi_drivers(trips, scope="clean")
    return within_bound(exact, op.taxi_drivers(trips, "approx", "clean"), "medallion")


@query
def both_shared_within_bound(spark: SparkSession, sf: str) -> DataFrame:
    """The two rankings with the approximate taxi table, whole: every taxi's approximate count beside the exact one,
    every driver's money and minutes, and a row without a key for how each ranking stands against its whole table.

    ``measure`` is the exact count or the money, or the number of places; ``within_bound`` of a driver says that the
    rate is money by minutes, and of a ranking that no place is off by more than the bound and that nobody who
    belongs there is missing.
    """
    trips = dirty_trips(spark, sf)
    tables = op.both_rankings_shared(trips, method="approx")
    exact, found = op.taxi_drivers(trips, scope="clean"), op.taxi_drivers(trips, "approx", "clean")
    drivers = op.driver_rates(trips)
    rates, ranked = (t.select("hack_license", "money_per_min").toDF("medallion", "num_drivers") for t in (drivers, tables["top_drivers"]))

    def part(rows: DataFrame, ranking: str, measure: Column | str, fits: Column | str, key: Column | str, minutes: Column | str) -> DataFrame:
        found = {"measure": measure, "minutes": minutes}
        return rows.select(
            F.lit(ranking).alias("ranking"), text(key).alias("key"), *[num(c).alias(n) for n, c in found.items()],
            (F.col(fits) if isinstance(fits, str) else fits).alias("within_bound"),
        )

    nothing, right = F.lit(None), (F.col("off") == 0) & ~F.col("missed")
    rated = F.abs(F.col("money_per_min") * F.col("minutes") - F.col("money")) <= F.abs("money") * 1e-9
    parts = [
        part(within_bound(exact, found, "medallion"), "top_taxis", "num_drivers", "within_bound", "medallion", nothing),
        part(drivers, "top_drivers", F.round("money", 2), rated, "hack_license", "minutes"),
        part(op.ranking_check(exact, tables["top_taxis"], 4 * SKETCH_RSD), "top_taxis", "ranked", right, nothing, nothing),
        part(op.ranking_check(rates, ranked, 1e-9), "top_drivers", "ranked", right, nothing, nothing),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def top_taxis_approx_within_bound(spark: SparkSession, sf: str) -> DataFrame:
    """The approximate top 10 itself: its counts, and whether a taxi that belongs there is missing."""
    trips = lineitem_trips(spark, sf)
    ranking = op.top_taxis(trips, method="approx", scope="clean")
    return op.ranking_check(op.taxi_drivers(trips, scope="clean"), ranking, 4 * SKETCH_RSD)


def sketched_batches(spark: SparkSession, sf: str) -> str:
    """Dirty lines in four batches by return flag and line status, each kept as sketches.

    The last one is added twice, as by a job that was run again.
    """
    where = sources.scratch_path(spark, "sketches")
    items = lineitem(spark, sf)
    batches = {"A": "l_returnflag = 'A'", "R": "l_returnflag = 'R'", "NF": "l_returnflag = 'N' AND l_linestatus = 'F'"}
    batches["rest"] = "NOT coalesce({}, false)".format(" OR ".join(f"({rule})" for rule in batches.values()))
    for batch, rule in [*batches.items(), ("rest", batches["rest"])]:
        path = text_file(spark, with_header(ad.dirty_trip_lines(items.filter(rule))), f"batch-{batch}")
        jobs.add_batch(spark, path, where, batch, layout="trip17", scope="clean")
    return where


@query
def sketches_merged_within_bound(spark: SparkSession, sf: str) -> DataFrame:
    """Every taxi's count from the stored sketches of four batches beside the exact one over all trips."""
    merged = op.merged_taxi_drivers(sources.read_sketches(spark, sketched_batches(spark, sf)))
    exact = op.taxi_drivers(dirty_trips(spark, sf), scope="clean")
    return within_bound(exact, merged, "medallion", op.sketch_bound())


@query
def job_top_taxis_of_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The ranking from stored sketches, as JSON read back, against the exact counts."""
    out = jobs.top_taxis_of_batches(spark, sketched_batches(spark, sf), sources.scratch_path(spark, "job-batches"))
    ranking = spark.read.schema("medallion string, num_drivers long").json(out)
    exact = op.taxi_drivers(dirty_trips(spark, sf), scope="clean")
    return op.ranking_check(exact, ranking, 4 * op.sketch_bound())


@query
def top_drivers_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The trips without a license, and those of one more driver, under the null key."""
    license = F.nullif(F.col("hack_license"), F.lit("H1"))
    trips = dirty_trips(spark, sf).withColumn("hack_license", license)
    return rates(op.top_drivers(trips, n=100, null_keys="keep"))


@query
def top_taxis_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """A group of taxis without a medallion, ranked under the null key."""
    medallion = F.when(~F.col("medallion").startswith("M1"), F.col("medallion"))
    trips = dirty_trips(spark, sf).withColumn("medallion", medallion)
    return op.top_taxis(trips, null_keys="keep")

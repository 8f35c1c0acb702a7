"""Whole jobs: from an input path to rankings and a report under an output directory."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmetrics import operators as op
from tripmetrics import sinks, sources
from tripmetrics.schema import (
    COST_PER_VCPU_MIN,
    LAYOUTS,
    RECORD,
    RUNS,
    SKETCH_RSD,
    SUMMARY_STYLES,
    TASKS,
    TRIP17_NAMES,
)

BEST_HOUR_COLUMNS = ("pickup_datetime", "trip_distance", "surcharge")


def result_dir(question: str, n: int = 10) -> str:
    """Directory of a JSON result: ``best_hour``, ``top_drivers_10``, ``top_taxis_10``."""
    return question if question == "best_hour" else f"{question}_{n}"


def stage(
    spark: SparkSession,
    path: str,
    staging: str,
    fmt: str = "csv_permissive",
    header: bool | str = False,
    layout: str | None = None,
    files: int | None = None,
    file_bytes: int | None = None,
    records: bool = False,
    by_day: bool = False,
    batch: str = "all",
) -> DataFrame:
    """Type any text input once and keep it as Parquet; gives back the staged trips.

    With ``records`` the staged rows say what record they came from. With ``by_day`` the set is kept by
    pickup day, and staging a batch of days again replaces those days only.
    """
    raw = sources.read_trips(spark, path, fmt, header=header, layout=layout, records=records)
    named = op.rename_layout(raw, layout) if layout and op.is_generic(raw) else raw
    typed = op.conform(named)
    if by_day:
        sinks.stage_days(typed, staging, batch, file_bytes)
    else:
        known = sources.listed_bytes(spark, path) if file_bytes else None
        sinks.stage_parquet(typed, staging, files, file_bytes, input_bytes=known)
    return sources.read_staged(spark, staging, records)


def add_batch(
    spark: SparkSession,
    path: str,
    sketches: str,
    batch: str,
    fmt: str = "lines",
    header: bool | str = True,
    layout: str | None = None,
    scope: str = "all",
    null_keys: str = "drop",
) -> str:
    """Read one batch of trips once and keep a sketch of its drivers for each taxi.

    ``top_taxis_of_batches`` ranks what has been kept so far without reading any trips again.
    """
    trips = op.normalize(sources.read_trips(spark, path, fmt, header=header, layout=layout), layout)
    found = op.taxi_sketches(trips, scope, null_keys=null_keys)
    return sinks.write_sketches(found, sketches, batch)


def top_taxis_of_batches(spark: SparkSession, sketches: str, out_dir: str, n: int = 10) -> str:
    """The approximate ranking over all batches, as JSON; gives back where it was written."""
    ranking = op.top_taxis_merged(sources.read_sketches(spark, sketches), n)
    return sinks.write_ranking_json(ranking, f"{out_dir.rstrip('/')}/{result_dir('top_taxis', n)}")


def run(
    spark: SparkSession,
    question: str,
    path: str,
    out_dir: str,
    fmt: str = "lines",
    header: bool | str = True,
    infer: bool = False,
    layout: str | None = None,
    staged: bool = False,
    staging: str | None = None,
    staging_files: int | None = None,
    staging_file_bytes: int | None = None,
    n: int = 10,
    pickup: str = "strict",
    method: str = "exact",
    scope: str = "all",
    rsd: float = SKETCH_RSD,
    vcpus: int = 6,
    cost_per_vcpu_min: float = COST_PER_VCPU_MIN,
    style: str = "economic",
    run_id: str = "run",
    null_keys: str = "drop",
    input_bytes: int | None = None,
    rejects: bool = False,
) -> dict[str, str]:
    """Answer one question, or ``both`` rankings; gives back where each result was written.

    Rankings are JSON lines, the report is ``results_summary`` as text. Text input is
    parsed once: one ranking holds its groups, ``both`` and the best hour the parsed
    columns. ``staged`` parses all columns into Parquet, which later jobs can use too.

    The ``economic`` report holds the result and counts every row read as a
    record; the other styles leave the result to the JSON and count clean rows.

    With ``rejects`` a JSON line ``rejects`` says how many rows the cleaning rule left
    out and how many records were shorter or wider than the layout, counted in the pass
    that parses them. ``input_bytes``, where it is known, saves asking the file system.
    """
    known = (*TASKS, "both")
    if question not in known:
        raise ValueError(f"unknown question {question!r}, expected one of {sorted(known)}")
    if style not in SUMMARY_STYLES:
        raise ValueError(f"unknown style {style!r}, expected one of {sorted(SUMMARY_STYLES)}")
    start = time.monotonic()
    out = out_dir.rstrip("/")
    staging = (staging or sinks.staging_path(out)) if staged else None
    if staging:
        trips = stage(
            spark, path, staging, fmt, header, layout, staging_files, staging_file_bytes, rejects
        )
    else:
        trips = sources.read_trips(spark, path, fmt, header, infer, layout, rejects)
    columns = len(op.value_columns(trips))
    width = LAYOUTS[layout][1] if layout else len(TRIP17_NAMES)
    if question == "best_hour":
        trips = op.name_columns(trips, layout).select(*BEST_HOUR_COLUMNS, *op.carried(trips))
    else:
        trips = op.normalize(trips, layout)

    rankings: dict[str, Callable[[], DataFrame]] = {
        "best_hour": lambda: op.best_hour(trips, pickup),
        "top_drivers": lambda: op.top_drivers(trips, n, null_keys),
        "top_taxis": lambda: op.top_taxis(trips, n, method, scope, rsd, null_keys),
    }
    questions = ["top_taxis", "top_drivers"] if question == "both" else [question]
    # Text is costly to parse. For one ranking its groups are held, which have the row
    # counts too; for both rankings and the best hour the parsed trips are.
    # Parquet is read again, a few columns at a time.
    parsed = not staging and fmt != "parquet"
    groups = None
    if parsed and question in ("top_drivers", "top_taxis"):
        groups, rank = op.counted_ranking(trips, question, n, method, scope, rsd, null_keys, width)
        rankings[question] = lambda: rank(groups)
    held = trips if groups is None else groups

    written: dict[str, str] = {}
    took: dict[str, float] = {}
    report: list[DataFrame] = []
    with sinks.held(held) if parsed else nullcontext():
        for i, q in enumerate(questions):
            begun = time.monotonic()
            ranking = rankings[q]()
            written[q] = sinks.write_ranking_json(ranking, f"{out}/{result_dir(q, n)}")
            took[q] = time.monotonic() - begun
            if style == "economic":
                lines = op.result_lines(spark.read.schema(ranking.schema).json(written[q]), q, n)
                report.append(lines.withColumn("ord", F.col("ord") + (n + 10) * i))
        runtime = time.monotonic() - start
        if groups is None:
            # The best hour has no cleaning rule: every row that was read counts.
            every = ~F.col(f"{RECORD}.dropped") if op.carried(trips) else F.lit(True)
            counted = op.run_facts(trips, every if question == "best_hour" else None, width)
        else:
            counted = op.grouped_facts(groups)
        (facts,) = counted.collect()
        rows_raw, rows_kept = facts["rows_raw"], facts["rows_kept"]

    one_run = {
        "run_id": run_id,
        "rows_raw": rows_raw,
        "records": rows_raw if style == "economic" else rows_kept,
        "input_bytes": sources.listed_bytes(spark, path) if input_bytes is None else input_bytes,
        "runtime_sec": runtime,
        "vcpus": vcpus,
        "task": "; ".join(TASKS[q].format(n=n) for q in questions),
        "input_path": path,
        "staging": staging,
        "output_json": "; ".join(written.values()),
        "taxis_sec": took.get("top_taxis"),
        "drivers_sec": took.get("top_drivers"),
    }
    runs = sources.from_rows(spark, [tuple(one_run[c] for c in RUNS.fieldNames())], RUNS)
    figures = op.summary(op.economics(runs, cost_per_vcpu_min), style).select(
        (F.col("ord") + (n + 10) * len(questions)).alias("ord"), "label", "value"
    )
    for lines in report:
        figures = figures.unionByName(lines)
    if rejects:
        counted = sources.from_rows(spark, [tuple(facts)], counted.schema)
        written["rejects"] = sinks.write_ranking_json(op.reject_facts(counted, columns), f"{out}/rejects")
    written["summary"] = sinks.write_summary_text(figures, f"{out}/results_summary")
    return written

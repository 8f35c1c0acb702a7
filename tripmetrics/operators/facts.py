"""Run facts: what was read, what was kept, what it cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmetrics.functions import clean_trip, plain_number, ratio_or_zero, rounded
from tripmetrics.operators.shaping import carried, fields
from tripmetrics.schema import (
    BEST_HOUR_LABELS,
    BYTES_PER_GB,
    COST_PER_VCPU_MIN,
    NO_RESULT_LABEL,
    RECORD,
    RESULT_HEADINGS,
    RUN_OPTIONS,
    SUMMARY_STYLES,
    TRIP17_NAMES,
)


def record_counts(trips: DataFrame, rule: Column, width: int = len(TRIP17_NAMES)) -> list[Column]:
    """The counts of a pass over trips: rows read and rows that pass the rule.

    Where the rows say what record they came from, also the records read, those with fewer
    fields than ``width`` and those with more; rows that are only there to be counted are no rows read.
    """
    kept = F.count_if(rule).alias("rows_kept")
    if not carried(trips):
        return [F.count(F.lit(1)).alias("rows_raw"), kept]
    fields = F.col(f"{RECORD}.fields")
    return [
        F.count_if(~F.col(f"{RECORD}.dropped")).alias("rows_raw"),
        kept,
        F.count(F.lit(1)).alias("records_read"),
        F.count_if(fields < width).alias("short_records"),
        F.count_if(fields > width).alias("wide_records"),
    ]


#: Counts of ``record_counts`` that can be added up over groups.
COUNTS = ("rows_raw", "rows_kept", "records_read", "short_records", "wide_records")


def run_facts(
    trips: DataFrame, rule: Column | None = None, width: int = len(TRIP17_NAMES)
) -> DataFrame:
    """Rows raw, kept and rejected by the cleaning rule, in one aggregate.

    An aggregate and not an observed metric: metrics are counted again when a
    lost executor makes a shuffle stage run twice.
    """
    counted = trips.agg(*record_counts(trips, clean_trip() if rule is None else rule, width))
    return with_rejected(counted)


def with_rejected(counted: DataFrame) -> DataFrame:
    rejected = (F.col("rows_raw") - F.col("rows_kept")).alias("rows_rejected")
    return counted.select("rows_raw", "rows_kept", rejected, *counted.columns[2:])


def line_facts(lines: DataFrame, width: int = len(TRIP17_NAMES)) -> DataFrame:
    """Lines in all, shorter than, as wide as and wider than ``width``, and the widest."""
    sized = lines.select(F.size(fields()).alias("n"))
    return sized.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("n") < width).alias("short_lines"),
        F.count_if(F.col("n") == width).alias("full_lines"),
        F.count_if(F.col("n") > width).alias("wide_lines"),
        F.max("n").alias("widest"),
    )


def reject_facts(facts: DataFrame, columns: int | None = None) -> DataFrame:
    """One row on what a job read but did not use, from its ``run_facts``.

    Records shorter than the layout are padded, wider ones lose fields or are dropped; ``columns`` is how
    many a table has, of which those past the layout are extra. Tables that say nothing of their
    records, such as Parquet, have as many as rows, all of one width.
    """
    counts = {c: F.col(c) for c in COUNTS if c in facts.columns}
    counts.setdefault("records_read", F.col("rows_raw"))
    for name in ("short_records", "wide_records"):
        counts.setdefault(name, F.lit(0))
    return facts.select(
        "rows_raw",
        "rows_kept",
        "rows_rejected",
        *[counts[c].cast("long").alias(c) for c in COUNTS[2:]],
        F.lit(max(0, (columns or 0) - len(TRIP17_NAMES))).cast("long").alias("extra_columns"),
    )


def input_bytes(files: DataFrame) -> DataFrame:
    """Number of input files, their bytes and the size in GB (1024 cubed), from
    ``sources.input_folders``."""
    return files.agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("files"), F.sum("bytes").alias("input_bytes")
    ).withColumn("input_gb", F.col("input_bytes") / F.lit(BYTES_PER_GB))


def economics(runs: DataFrame, cost_per_vcpu_min: float = COST_PER_VCPU_MIN) -> DataFrame:
    """Throughput and cost columns over a table of runs (see ``schema.RUNS``).

    Size unknown gives a null cost per GB; a zero denominator gives 0.0.
    """
    run_minutes = F.col("runtime_sec") / F.lit(60.0)
    return (
        runs.withColumn("vcpu_minutes", F.col("vcpus") * run_minutes)
        .withColumn("cost_usd", F.col("vcpu_minutes") * F.lit(cost_per_vcpu_min))
        .withColumn("input_gb", F.col("input_bytes") / F.lit(BYTES_PER_GB))
        .withColumns(
            {
                "records_per_sec": ratio_or_zero(
                    F.col("records").cast("double"), F.col("runtime_sec")
                ),
                "cost_per_gb": F.when(
                    F.col("input_gb").isNotNull(), ratio_or_zero("cost_usd", "input_gb")
                ),
                "cost_per_record": ratio_or_zero("cost_usd", F.col("records").cast("double")),
                "records_per_usd": ratio_or_zero(F.col("records").cast("double"), "cost_usd"),
            }
        )
    )


# -------------------------------------------------------------------- summary


def summary(economics_row: DataFrame, style: str = "economic") -> DataFrame:
    """The report lines of each run: ``run_id``, ``ord``, ``label``, ``value``.

    Values are text ready for printing. Headings have an empty quoted value,
    unknown figures the value ``None``; lines that do not apply are left out.
    """
    types = dict(economics_row.dtypes)
    lines = [
        _line(i, F.lit(label), F.lit("''") if column is None else _figure(column, types, digits))
        for i, (label, column, digits) in enumerate(SUMMARY_STYLES[style])
        if column is None or column in types
    ]
    return economics_row.select("run_id", F.inline(F.array(*lines))).filter(
        F.col("value").isNotNull()
    )


def _figure(column: str, types: dict[str, str], digits: int | None) -> Column:
    kind = types[column]
    if kind == "string":
        shown = F.concat(F.lit("'"), F.col(column), F.lit("'"))
    elif kind == "double":
        shown = plain_number(rounded(column, digits))
    else:
        shown = F.col(column).cast("string")
    return shown if column in RUN_OPTIONS else F.coalesce(shown, F.lit("None"))


def result_lines(ranking: DataFrame, question: str, n: int = 10) -> DataFrame:
    """A ranking of ``n`` places as report lines ``ord``, ``label``, ``value`` under its heading.

    ``ranking`` has a key and a measure and at most as many rows as were asked
    for, so numbering them in one task is bounded work. It is read twice: pass a
    ranking that was written out, not one still to be computed.
    """
    key, measure = ranking.columns
    spark = ranking.sparkSession
    heading = spark.createDataFrame(
        [(-2, RESULT_HEADINGS[question].format(n=n), "''")], "ord int, label string, value string"
    )
    if question == "best_hour":
        hour, average = BEST_HOUR_LABELS
        rows = ranking.select(
            F.inline(
                F.array(
                    _line(0, F.lit(hour), F.col(key).cast("string")),
                    _line(1, F.lit(average), plain_number(rounded(measure, 4))),
                )
            )
        )
    else:
        best_first = W.orderBy(F.desc(measure), F.asc(key))
        double = dict(ranking.dtypes)[measure] == "double"
        shown = plain_number(rounded(measure, 4)) if double else F.col(measure).cast("string")
        rows = ranking.select(
            F.row_number().over(best_first).cast("int").alias("ord"),
            F.col(key).alias("label"),
            shown.alias("value"),
        )
    none = ranking.agg(F.count(F.lit(1)).alias("n")).filter("n = 0")
    empty = none.select(
        F.lit(-1).alias("ord"), F.lit(NO_RESULT_LABEL).alias("label"), F.lit("''").alias("value")
    )
    return heading.unionByName(rows).unionByName(empty)


def _line(order: int, label: Column, value: Column) -> Column:
    return F.struct(F.lit(order).alias("ord"), label.alias("label"), value.alias("value"))

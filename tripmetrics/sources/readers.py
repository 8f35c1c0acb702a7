"""Readers for trip data: text lines, CSV, Parquet, from any path Hadoop can open."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from heapq import merge

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripmetrics.operators.shaping import (
    csv_fields,
    drop_header,
    line_widths,
    lines_to_columns,
    record,
    settled_width,
)
from tripmetrics.schema import LAYOUTS, RECORD, RECORD_TYPE, TRIP17

Paths = str | list[str]


# ----------------------------------------------------------------- text lines


def header_line(spark: SparkSession, path: Paths) -> str | None:
    """The first line of the first file, by path, that has one.

    A text read over many files promises no order, so the file is picked from
    the listing and only its first block is looked at.
    """
    for file in _files_in_order(spark, path):
        lines = spark.read.text(_literal(file))
        first = lines.filter(F.col("_metadata.file_block_start") == 0).select("value").first()
        if first is not None:
            return first["value"]
    return None


def _literal(name: str) -> str:
    """A path pattern for one file name, whatever pattern characters it holds."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", name)


def _files_in_order(spark: SparkSession, path: Paths) -> Iterator[str]:
    """Input files that are not empty, by path.

    The file system's sorted listing stays in the JVM; a name comes over when it
    is asked for, mostly one.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def under(pattern: str) -> Iterator[str]:
        place = jvm.org.apache.hadoop.fs.Path(pattern)
        for status in place.getFileSystem(conf).globStatus(place) or []:
            name = status.getPath().toString()
            if status.isFile():
                if status.getLen():
                    yield name
            else:
                yield from (f for f in under(f"{_literal(name)}/*") if not _hidden(f, name))

    def _hidden(file: str, folder: str) -> bool:
        return any(part[:1] in ("_", ".") for part in file[len(folder) + 1 :].split("/"))

    return merge(*(under(one) for one in ([path] if isinstance(path, str) else path)))


def read_lines(spark: SparkSession, path: Paths, header: bool | str = True) -> DataFrame:
    """Text lines as ``value``; ``.gz`` and ``.bz2`` are unpacked by their suffix.

    With ``header`` the first line and every line equal to it are dropped. Give
    the header text itself, where it is known, to save looking for it. A gzip
    file cannot be split: one large file is one task until it is staged.
    """
    if isinstance(header, bool):
        header = header_line(spark, path) if header else None
    return drop_header(spark.read.text(path), header)


def input_folders(spark: SparkSession, path: Paths) -> DataFrame:
    """``folder``, ``files`` and ``bytes`` of each folder of the input, and of each file beside them.

    The file system sums up each folder, several at a time, so no task runs, whatever the files
    hold, and no file name comes over: a row for each folder that lies directly under a path (a
    day of a partitioned table, say). Hidden folders and files (``_`` or ``.``) do not count.
    """
    sc = spark.sparkContext
    conf = sc._jsc.hadoopConfiguration()

    def summed(place: str) -> tuple[str, int, int]:
        where = sc._jvm.org.apache.hadoop.fs.Path(place)
        found = where.getFileSystem(conf).getContentSummary(where)
        return place, found.getFileCount(), found.getLength()

    places: list[str] = []
    for one in [path] if isinstance(path, str) else path:
        where = sc._jvm.org.apache.hadoop.fs.Path(one)
        system = where.getFileSystem(conf)
        for status in system.globStatus(where) or []:
            inside = system.listStatus(status.getPath()) if status.isDirectory() else [status]
            places += (x.getPath().toString() for x in inside if x.getPath().getName()[:1] not in ("_", "."))
    with ThreadPoolExecutor(16) as pool:
        rows = list(pool.map(summed, places))
    return spark.createDataFrame(rows, "folder string, files long, bytes long")


def listed_bytes(spark: SparkSession, path: Paths) -> int:
    """Bytes of all input files, from the file system's own summary.

    No task runs and no file name comes to Python, however large the input is.
    """
    sc = spark.sparkContext
    total = 0
    for one in [path] if isinstance(path, str) else path:
        place = sc._jvm.org.apache.hadoop.fs.Path(one)
        system = place.getFileSystem(sc._jsc.hadoopConfiguration())
        for status in system.globStatus(place) or []:
            total += system.getContentSummary(status.getPath()).getLength()
    return total


# ------------------------------------------------------------------------ CSV


def generic_schema(width: int) -> StructType:
    """``_c0 .. _cN``, all text."""
    return StructType([StructField(f"_c{i}", StringType()) for i in range(width)])


def read_csv(
    spark: SparkSession,
    path: Paths,
    header: bool = True,
    infer: bool = False,
    schema: StructType | None = None,
    mode: str = "DROPMALFORMED",
) -> DataFrame:
    """CSV with quotes, one record per line; malformed records dropped by default.

    Whole records are always parsed (``columnPruning`` off): with pruning Spark
    judges only the columns a query asks for, so the set of dropped records, and
    with it a plain count, would change from query to query. ``infer`` reads the
    data once more; leave it off at scale, the typing happens in ``normalize``.
    """
    reader = (
        spark.read.option("header", header)
        .option("mode", mode)
        .option("columnPruning", False)
        .option("multiLine", False)
    )
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_csv_permissive(
    spark: SparkSession, path: Paths, width: int | None = None, header: bool = False
) -> DataFrame:
    """CSV as text columns ``_c0 .. _cN``; short records padded with null.

    Records are kept whatever their width, so columns can be pruned; with ``width``
    longer ones lose what is past it (``record_widths`` and ``csv_quality`` count
    them). Without ``width`` the records have to agree on one, see
    ``settled_width``: the first record alone never decides it.
    """
    if width is None and not header:
        width = settled_width(record_widths(spark, path))
    reader = (
        spark.read.option("header", header)
        .option("mode", "PERMISSIVE")
        .option("multiLine", False)
        .option("enforceSchema", width is not None)
    )
    return reader.schema(generic_schema(width)).csv(path) if width else reader.csv(path)


def record_widths(spark: SparkSession, path: Paths) -> DataFrame:
    """``width`` and ``lines``: how many CSV records have how many fields, quotes respected."""
    records = spark.read.text(path).filter(F.col("value") != "")
    return records.groupBy(csv_fields("value").alias("width")).agg(F.count(F.lit(1)).alias("lines"))


def read_csv_records(
    spark: SparkSession,
    path: Paths,
    schema: StructType,
    header: bool,
    dropped: bool,
) -> DataFrame:
    """CSV with every record, and beside each row how many fields its record had.

    Only malformed records are looked at again, in the pass that parses them. With ``dropped``
    their rows are empty and only there to be counted.
    """
    marker = "_malformed"
    records = (
        spark.read.option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", marker)
        .schema(StructType(list(schema)).add(marker, "string"))
        .csv(path)
    )
    bad = F.col(marker).isNotNull()
    names = [F.col(f"`{name}`") for name in schema.fieldNames()]
    values = [F.when(~bad, c).alias(n) for c, n in zip(names, schema.fieldNames())] if dropped else names
    fields = F.when(bad, csv_fields(marker)).otherwise(len(names))
    return records.select(*values, record(fields, bad if dropped else None))


def csv_quality(spark: SparkSession, path: Paths, schema: StructType, header: bool) -> DataFrame:
    """Good and malformed records of a CSV, and good ones without a first field, in one
    aggregate over whole records."""
    marker = "_malformed"
    records = (
        spark.read.option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", marker)
        .schema(StructType(list(schema)).add(marker, "string"))
        .csv(path)
    )
    good = F.col(marker).isNull()
    return records.agg(
        F.count_if(good).alias("good_rows"),
        F.count_if(~good).alias("malformed_rows"),
        F.count_if(good & F.col(schema.fieldNames()[0]).isNull()).alias("keyless_rows"),
    )


# -------------------------------------------------------------------- Parquet


def read_parquet(spark: SparkSession, path: Paths, schema: StructType | None = None) -> DataFrame:
    """Parquet without schema merging: one footer gives the schema, not all of them."""
    reader = spark.read.option("mergeSchema", False)
    return (reader.schema(schema) if schema is not None else reader).parquet(
        *([path] if isinstance(path, str) else path)
    )


def read_staged(
    spark: SparkSession, path: Paths, records: bool = False, days: tuple[str, str] | None = None
) -> DataFrame:
    """A staging set written by ``sinks.stage_parquet`` or ``sinks.stage_days``.

    With ``records`` its rows say what records they came from, if they were staged so; without,
    rows that are only there to be counted stay away. ``days`` is the first and the last pickup
    day to read of a set that is kept by day; others are not opened.
    """
    staged = read_parquet(spark, path, StructType(list(TRIP17)).add(RECORD, RECORD_TYPE))
    if days:
        staged = staged.filter(F.col("pickup_day").between(*(F.lit(d).cast("date") for d in days)))
    if not records:
        counted_only = F.coalesce(F.col(f"{RECORD}.dropped"), F.lit(False))
        return staged.filter(~counted_only).select(*TRIP17.fieldNames())
    fields = F.coalesce(F.col(f"{RECORD}.fields"), F.lit(len(TRIP17)))
    dropped = F.coalesce(F.col(f"{RECORD}.dropped"), F.lit(False))
    return staged.select(*TRIP17.fieldNames(), record(fields, dropped))


def read_sketches(spark: SparkSession, path: Paths) -> DataFrame:
    """The sketches of all batches written by ``sinks.write_sketches``."""
    return read_parquet(spark, path).select("medallion", "drivers", F.col("batch").cast("string"))


# ------------------------------------------------------------------ by format


def read_trips(
    spark: SparkSession,
    path: Paths,
    fmt: str = "parquet",
    header: bool | str = True,
    infer: bool = False,
    layout: str | None = None,
    records: bool = False,
) -> DataFrame:
    """Trips in whatever columns they have, by format name.

    ``parquet``, ``csv`` (quotes respected, malformed records dropped),
    ``csv_permissive`` (every record kept) or ``lines`` (plain split, padded).
    A ``layout`` hint tells the width of text input, which saves the pass that
    measures it; without one, nameless records that disagree in width are an
    error. With ``records`` the rows of text input say what record they came from, and
    dropped records have an empty row to be counted by. Feed the result to ``normalize`` or ``conform``.
    """
    width = LAYOUTS[layout][1] if layout else None
    if fmt == "parquet":
        return read_parquet(spark, path)
    if fmt in ("csv", "csv_permissive"):
        if not header and not width:
            width = settled_width(record_widths(spark, path))
        known = generic_schema(width) if width and not header else None
        if records:
            named = known or read_csv(spark, path, bool(header), infer, mode="PERMISSIVE").schema
            return read_csv_records(spark, path, named, bool(header), dropped=fmt == "csv")
        if fmt == "csv":
            return read_csv(spark, path, bool(header), infer, known)
        return read_csv_permissive(spark, path, width, bool(header))
    if fmt == "lines":
        lines = read_lines(spark, path, header)
        width = width or settled_width(line_widths(lines))
        return lines_to_columns(lines, width, blank_as_null=True, records=records)
    raise ValueError(f"unknown format {fmt!r}, expected parquet, csv, csv_permissive or lines")


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """A small local list, such as one run's figures, as a DataFrame."""
    return spark.createDataFrame(list(rows), schema)

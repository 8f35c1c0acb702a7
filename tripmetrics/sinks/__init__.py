"""Trip sinks: Parquet staging, JSON rankings, text summaries, cached tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager, nullcontext

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tripmetrics.functions import event_time

#: A task of a sized set writes so many files at most, and shuffled bytes, and a set of few files has so many tasks at least.
TASK_FILES, TASK_BYTES, LEAST_TASKS = 32, 8 * 1024 * 1024, 16
PIECE = "piece"


def staging_path(out_dir: str) -> str:
    """Default place of the staging set under an output directory."""
    return f"{out_dir.rstrip('/')}/staging_parquet"


def stage_parquet(
    df: DataFrame,
    path: str,
    files: int | None = None,
    file_bytes: int | None = None,
    by: tuple[str, ...] = ("medallion", "hack_license"),
    input_bytes: int | None = None,
) -> str:
    """Write a compact snappy Parquet set, replacing what is there; gives back its path.

    Without more said each task writes what it read, and no data moves, so there are as many
    files as tasks that read. ``file_bytes`` asks for files of one size, so many bytes
    of shuffled rows each: rows go by ``by``, and the adaptive plan splits what is larger and
    joins what is smaller, whatever the size of the input splits. ``files`` forces that many files, which
    suits small sets only.

    To start a task of a write costs the same whatever it holds, which is much for a small file. Where
    ``input_bytes`` says that the input is large, each task deals its rows out evenly to several files, one
    in each of the folders ``piece=0``, ``piece=1``, ...
    """
    if files is not None and file_bytes is not None:
        raise ValueError("give files or file_bytes, not both")
    if files is not None:
        df = df.repartition(files)
    if file_bytes is None:
        df.write.mode("overwrite").option("compression", "snappy").parquet(path)
        return path
    named = PIECE in (c.lower() for c in df.columns)
    each = 1 if named else _files_of_a_task(file_bytes, input_bytes or 0)
    with _advised(df.sparkSession, each * file_bytes), _open_files(df.sparkSession, each):
        sized = df.hint("rebalance", *by)
        if each > 1:
            sized = sized.withColumn(PIECE, F.pmod(F.monotonically_increasing_id(), F.lit(each)).cast("int"))
        writer = sized.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "snappy")
        (writer.partitionBy(PIECE) if each > 1 else writer).parquet(path)
    return path


def _files_of_a_task(file_bytes: int, input_bytes: int) -> int:
    return max(1, min(TASK_FILES, TASK_BYTES // file_bytes, input_bytes // (LEAST_TASKS * file_bytes)))


def _advised(spark: SparkSession, size: int) -> AbstractContextManager[None]:
    """The adaptive plan aims at ``size`` bytes for each task meanwhile."""
    wanted = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(max(1, size // 2)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(size),
    }
    return _settings(spark, wanted)


def _open_files(spark: SparkSession, most: int) -> AbstractContextManager[None]:
    """A task keeps the files of so many folders open meanwhile, and rows go straight into them, unsorted."""
    return _settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(most)})


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stage_days(df: DataFrame, path: str, batch: str = "all", file_bytes: int | None = None) -> str:
    """Keep trips (trip17) by pickup day; staging again replaces the days that ``df`` has and no others.

    A batch is whole days. Trips without a readable pickup have no day: they are kept by the name of
    their ``batch``, and replaced with it. A day's trips are spread over as many files as their
    size needs, and small days are one file.
    """
    written = isinstance(df.schema["pickup_datetime"].dataType, StringType)
    day = F.to_date(event_time("pickup_datetime", "multi") if written else F.col("pickup_datetime"))
    dated = df.withColumns(
        {"pickup_day": day, "batch": F.when(day.isNull(), F.lit(batch)).otherwise(F.lit("dated"))}
    )
    with _advised(df.sparkSession, file_bytes) if file_bytes else nullcontext():
        (
            dated.hint("rebalance", "pickup_day", "batch")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy")
            .partitionBy("pickup_day", "batch")
            .parquet(path)
        )
    return path


def write_text_folders(lines: DataFrame, path: str, by: str, open_files: int = 100) -> str:
    """Write text lines (``by`` and one more column) into a folder for each value of ``by``; gives back the path.

    No row is sorted: a task keeps the files of its folders open, as long as they are no more than ``open_files``, and
    rows go straight into them, so what a task holds does not grow with the rows of a folder.
    """
    with _open_files(lines.sparkSession, open_files):
        lines.write.partitionBy(by).text(path)
    return path


def write_sketches(sketches: DataFrame, path: str, batch: str) -> str:
    """Keep the sketches of one batch of trips beside those of others; gives back the path.

    The batch is a partition of the set. Writing it again replaces that batch alone, so a job that
    failed half-way is simply run once more.
    """
    (
        sketches.withColumn("batch", F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(path)
    )
    return path


def write_ranking_json(ranking: DataFrame, path: str) -> str:
    """Write a ranking as one file of JSON lines, replacing what is there."""
    ranking.coalesce(1).write.mode("overwrite").json(path)
    return path


def summary_line(label: str = "label", value: str = "value") -> Column:
    """``('label', value)`` as text."""
    return F.format_string("('%s', %s)", F.col(label), F.col(value))


def write_summary_text(summary: DataFrame, path: str, by_run: bool = False) -> str:
    """Write report lines in the order of ``ord`` as text, replacing what is there.

    One report, a few dozen lines, becomes one file. A table of reports, told
    apart by ``run_id``, becomes one text set sorted by run, each line after its run
    and a tab; ``by_run`` gives each run a directory of its own instead.
    """
    line = summary_line()
    if "run_id" not in summary.columns:
        spread = summary.coalesce(1).sortWithinPartitions("ord")
        writer = spread.select(line.alias("value")).write
    elif by_run:
        spread = summary.repartition("run_id").sortWithinPartitions("run_id", "ord")
        writer = spread.select("run_id", line.alias("value")).write.partitionBy("run_id")
    else:
        spread = summary.orderBy("run_id", "ord")
        writer = spread.select(F.concat_ws("\t", "run_id", line).alias("value")).write
    writer.mode("overwrite").text(path)
    return path


@contextmanager
def held(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a projected table cached while more than one ranking reads it.

    A lost block is computed again from its source, and the cache is dropped at
    the end in any case.
    """
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()

"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmetrics.sources import read_parquet
from tripmetrics.sources.scratch import scratch_path

#: What separates words: the six ASCII blanks.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def kept(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once to the shared folder, with the writer's ``options``, and read from there, so that its lineage ends."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that begin meanwhile drop their shuffle files as soon as they have ended."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def numbered(df: DataFrame, row: str, *order: str) -> DataFrame:
    """``df`` with ``row``: 0, 1, 2 and so on in the order of the columns, nulls first.

    ``df`` should be a stored table, as it is read twice (the ranges of the order are drawn from it).
    Tasks sort ranges of that order, and the sorted table is written once, so the numbers stay the same
    when an executor is lost. Rows that are equal in all columns of the order are numbered as they
    lie; they may span tasks, however many they are.
    """
    place, part, begin = (unused(df, name) for name in ("_place", "_part", "_begin"))
    ordered = (
        df.withColumn(place, F.monotonically_increasing_id())
        .repartitionByRange(*order, place)
        .sortWithinPartitions(*order, place)
        .withColumn(place, F.monotonically_increasing_id())  # the task above, the row in it below
        .withColumn(part, F.shiftright(place, 33))
    )
    ordered = kept(ordered, f"by-{row}")
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    begins = ordered.groupBy(part).agg(F.count(F.lit(1)).alias(begin))
    begins = begins.withColumn(begin, F.coalesce(F.sum(begin).over(earlier), F.lit(0)))
    inside = F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.join(begins, part).withColumn(row, F.col(begin) + inside).drop(part, place, begin)


def words(text: Column) -> Column:
    """The words of a text: runs of anything but ASCII blanks. Null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def fraction_for(bound: int, total: int) -> float:
    """Share of rows to draw so that a sample holds about ``bound`` of ``total`` rows."""
    return 1.0 if total <= bound else bound / total


def drawn(share: float, *columns: str) -> Column:
    """True for a fixed share of rows, the same rows in every run and on every cluster."""
    if share >= 1.0:
        return F.lit(True)
    return F.pmod(F.xxhash64(F.lit("sample"), *columns), F.lit(1 << 30)) < int(share * (1 << 30))


def own_columns(df: DataFrame) -> list[Column]:
    """All columns of ``df`` by name, whatever characters the names hold."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def unused(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores in front as it takes to clash with no column of ``df``."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_length(df: DataFrame, changed: Column) -> DataFrame:
    """n_chars, where it is a column, follows the text where ``changed`` holds."""
    if "n_chars" not in df.columns:
        return df
    length = F.length("text").cast(df.schema["n_chars"].dataType)
    return df.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))

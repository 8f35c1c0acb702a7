"""A corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession

from tripmetrics.llm import bin_slack, line_dedup, secret_forest, simhash_grid, weak_toxicity
from tripmetrics.llm.common import kept, table
from tripmetrics.llm.queries import RANKS, VOCABULARY


#: Rows of an Arrow batch. Whole texts go through Python workers, in the JVM's and in the worker's memory at
#: once; Spark's own 10,000 rows of some kilobytes each are too many beside a full heap.
BATCH_ROWS = "1000"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch, unless the session asks for fewer already."""
    if int(spark.conf.get(_BATCH)) > int(BATCH_ROWS) or int(spark.conf.get(_BATCH)) <= 0:
        spark.conf.set(_BATCH, BATCH_ROWS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go.

    Null and empty texts are scored as empty; repeated rows go or stay alike; no rows give no rows.
    """
    small_batches(spark)
    return weak_toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal and similar lines the first stays; documents that keep no word of theirs go.

    Of repeated rows one stays; null and empty texts have no lines to lose.
    """
    small_batches(spark)
    return line_dedup.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays.

    Groups are those of the operator's query (3-word shingles, 3 bits); texts without a word, null ones too, are
    one group.
    """
    small_batches(spark)
    return simhash_grid.representatives(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark; no document goes, null and empty texts stay as they are."""
    return secret_forest.redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenised pieces with their sequences and places; a null text has the end id alone."""
    small_batches(spark)
    return bin_slack.pack_documents(
        docs, public_tokenizers.path(RANKS), vocabulary=public_tokenizers.path(VOCABULARY)
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", repeated_lines),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scan", secrets),
    ("best_fit_packing", packing),
]

#: No SQL can say what a trained classifier keeps; tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name)
    return docs

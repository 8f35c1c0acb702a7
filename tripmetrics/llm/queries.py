"""The queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmetrics.llm import (
    bin_slack,
    bpe_tree,
    closed_syncmers,
    cutting_stock,
    hadamard_codes,
    line_dedup,
    loss_difference,
    merkle_manifest,
    rule_cascade,
    secret_forest,
    simhash_grid,
    training_order,
    weak_toxicity,
)
from tripmetrics.llm.common import table

#: Rank file of the byte-level vocabulary; the library takes the path as a parameter.
RANKS = "byte_bpe_50k.tiktoken"
#: The same vocabulary with its added tokens.
VOCABULARY = "byte_bpe_50k.json"
#: Key of the training order.
ORDER_KEY = 20_260_713


def _ranks() -> str:
    return public_tokenizers.path(RANKS)


def op1_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document; the value itself is given as its digest only."""
    found = secret_forest.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "path", "ordinal", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"), "score", "secret"
    )


def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.training_order(table(spark, sf_dir, "documents"), _ranks(), ORDER_KEY)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_decisions(table(spark, sf_dir, "documents"))


def op4_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_cascade.rule_cascade(table(spark, sf_dir, "documents"))


def op6_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closed_syncmers.fingerprint_documents(table(spark, sf_dir, "documents"))


def op7_simhash_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_grid.near_duplicates(table(spark, sf_dir, "documents"))


def op8_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tree.round_trip_digests(table(spark, sf_dir, "documents"), _ranks())


def op9_loss_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target are the documents that labels call good."""
    good = table(spark, sf_dir, "labels").filter("quality = 1")
    found = loss_difference.loss_difference(table(spark, sf_dir, "documents"), good)
    figures = ("target_loss", "background_loss", "score")
    return found.select("doc_id", "n_words", *(F.round(c, 6).alias(c) for c in figures))


def op10_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_slack.pack_documents(
        table(spark, sf_dir, "documents"), _ranks(), vocabulary=public_tokenizers.path(VOCABULARY)
    )


def op11_hadamard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hadamard_codes.compressed(table(spark, sf_dir, "embeddings"))


def op12_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path(VOCABULARY)
    return cutting_stock.pack_documents(table(spark, sf_dir, "documents"), _ranks(), vocabulary)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_forest": op1_secret_forest,
    "op2_training_order": op2_training_order,
    "op3_line_dedup": op3_line_dedup,
    "op4_weak_toxicity": op4_weak_toxicity,
    "op5_rule_cascade": op5_rule_cascade,
    "op6_closed_syncmers": op6_closed_syncmers,
    "op7_simhash_grid": op7_simhash_grid,
    "op8_bpe_tree": op8_bpe_tree,
    "op9_loss_difference": op9_loss_difference,
    "op10_bin_slack": op10_bin_slack,
    "op11_hadamard_codes": op11_hadamard_codes,
    "op12_cutting_stock": op12_cutting_stock,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES: dict[str, str] = {
    "op5_rule_cascade": rule_cascade.ORACLE,
    "op9_loss_difference": loss_difference.ORACLE,
    "op11_hadamard_codes": hadamard_codes.ORACLE,
    "op13_merkle_manifest": merkle_manifest.ORACLE,
}

"""Document fingerprints from closed syncmers.

A k-mer of characters is chosen if the smallest of its inner s-mers lies at either edge. That
depends on the k-mer alone, so an edit moves no anchor outside the k-mers it touches, and two texts
share the anchors of every passage they share. The fingerprint is the bottom sketch of the anchors'
hashes: the smallest ones, which estimate the share of anchors that two texts have in common.
"""

from __future__ import annotations

import hashlib

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of an anchor and of its inner strings.
K, S = 16, 5
#: Hashes that a fingerprint keeps.
SKETCH = 64
#: Order of rows without an id: after all others.
NO_ID = -(1 << 63)

_MUL = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _windows(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` characters."""
    n = len(codes) - width + 1
    h = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        h = h * _MUL + codes[i : i + n]
    return _mixed(h)


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Places (in characters) and hashes of the closed syncmers of a text.

    An edge that ties for the smallest counts. A text shorter than k has one anchor, the whole
    text; an empty text has none.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    if not len(codes):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    if len(codes) < k:
        return np.zeros(1, np.int64), _windows(codes, len(codes))
    inner = _windows(codes, s)
    n, span = len(codes) - k + 1, k - s + 1
    first, last = inner[:n], inner[span - 1 : span - 1 + n]
    # Smallest of the s-mers between the edges, by doubling: shift 2^i keeps the minimum of 2^i.
    width, least = 1, inner
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    lowest = np.minimum(least[:n], least[span - width : span - width + n])
    at = np.flatnonzero((first == lowest) | (last == lowest))
    if not len(at):
        return at, np.empty(0, np.uint64)
    h = np.zeros(len(at), dtype=np.uint64)
    for i in range(k):
        h = h * _MUL + codes[at + i]
    return at, _mixed(h)


def sketch(text: str, size: int = SKETCH) -> np.ndarray:
    """The smallest distinct anchor hashes of a whole text, in order.

    A text of k characters or little more can lack anchors (its smallest inner strings all lie
    inside); it then counts as one anchor, so only the empty text has an empty sketch.
    """
    _, hashes = anchors(text)
    if text and not len(hashes):
        hashes = np.frombuffer(hashlib.sha256(text.encode()).digest()[:8], dtype="<u8")
    return np.unique(hashes)[:size]


def written(found: np.ndarray) -> str:
    return found.astype(">u8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> float:
    """Share of the smallest hashes of both that each holds; two empty texts are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:size]
    return float(np.isin(both, np.intersect1d(a, b, assume_unique=True)).sum() / len(both))


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def anchor_table(docs: DataFrame) -> DataFrame:
    """doc_id, place and anchor of every closed syncmer, to match passages by place.

    A null text has no anchors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                places, hashes = anchors(value.as_py() or "")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(places), pa.int64()), pa.array(places, pa.int64()), pa.array(hashes.view(np.int64))],
                    names=["doc_id", "place", "anchor"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, place long, anchor long")


def in_runs(docs: DataFrame) -> DataFrame:
    """``run``, ``place``, ``key``, doc_id and text, so that each row's successor is in its run.

    The order is descending doc_id, nulls last, equal ids by text. Runs are ranges of ids, as many
    as shuffles have partitions; rows that share an id share a run. The rows with the first id of
    a run (of the first run: wrapped around) are dealt to the run before as well, with place 1.
    """
    spark = docs.sparkSession
    docs = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("doc_id", F.lit(NO_ID)).alias("key"),
    )
    runs = int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [k / runs for k in range(1, runs)] or [0.5]
    cuts = docs.agg(F.percentile_approx("key", F.lit(steps), 20 * runs)).first()[0] or []
    ends = np.unique(np.array(cuts, dtype=np.int64))

    @F.pandas_udf("long")
    def run_of(key: pd.Series) -> pd.Series:
        return pd.Series(len(ends) - np.searchsorted(ends, key.to_numpy(), side="left"))

    docs = docs.withColumn("run", run_of("key"))
    firsts = sorted(docs.groupBy("run").agg(F.max("key")).collect())  # a row for each run
    before = [(run, first, firsts[k - 1][0]) for k, (run, first) in enumerate(firsts)]
    heads = spark.createDataFrame(before, "run long, first long, before long")
    own = F.struct("run", F.lit(0).alias("place"))
    ahead = F.struct(F.col("before").alias("run"), F.lit(1).alias("place"))
    dealt = F.when(F.col("key") == F.col("first"), F.array(own, ahead)).otherwise(F.array(own))
    return (
        docs.join(F.broadcast(heads), "run")  # one row for each run
        .select(F.explode(dealt).alias("at"), "key", "doc_id", "text")
        .select("at.run", "at.place", "key", "doc_id", "text")
    )


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last = None  # run, doc_id, text and sketch of the row whose successor comes next
    for batch in batches:
        out = []
        for run, place, _, doc, text in zip(*(batch.column(i) for i in range(5))):
            run, place, doc = run.as_py(), place.as_py(), doc.as_py()
            if place and last is None:
                continue  # a further row with the first id of the next run
            text = text.as_py()
            own = sketch(text)
            if last is not None:
                _, before, its, had = last
                new = edited(its, text)
                changed = sketch(new)
                out.append(
                    (
                        before,
                        len(its),
                        hashlib.sha256(new.encode()).hexdigest(),
                        written(had),
                        written(changed),
                        likeness(had, changed),
                        likeness(had, own),
                    )
                )
            last = None if place else (run, doc, text, own)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [field.split()[0] for field in SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=names
        )


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    ``docs`` has doc_id and text; other columns are not looked at. A null text is empty; an empty
    text has the empty fingerprint, which is like another empty one (1) and like no other (0). The
    next document is the one with the next smaller doc_id (nulls last, equal ids by text, after the
    last the first), so a single document is its own successor. Repeated rows stay repeated.
    """
    return (
        in_runs(docs)
        .repartition("run")
        .sortWithinPartitions("run", "place", F.desc("key"), "text")
        .mapInArrow(_compared, SCHEMA)
    )

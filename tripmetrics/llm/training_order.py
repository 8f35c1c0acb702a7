"""Training-order materialisation of token sequences.

Token streams are cut into sequences of one length. A keyed Feistel permutation with cycle-walking
gives every sequence its global slot, so the training order is random, needs no sort key and can be
computed for any sequence alone. Texts are tokenised once: sequences are stored as records, counted and
numbered from the stored table. Ranges of slots become shards of fixed-stride records, a few ranges after
another, so that only a part of the records lies in shuffle files at a time: slot k lies
in shard ``k // per_shard`` at byte ``(k % per_shard) * STRIDE``, so a reader goes through the shards in
order, and resumes anywhere, by arithmetic.

A record is the header (doc_id int64, start uint32, length uint16, crc32 uint32, little-endian), the
ids as little-endian uint16, zeros up to the sequence length, and a line feed. It is written by
Spark's text sink, whose committer keeps shards whole when executors are lost; readers go by the
stride and never look for line feeds.
"""

from __future__ import annotations

import struct
import zlib

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmetrics.llm.common import kept, shuffles_dropped
from tripmetrics.llm.tokens import part_encoder, read_ranks
from tripmetrics.sources.scratch import scratch_path

#: Tokens of a sequence, and sequences of a shard.
LENGTH = 512
PER_SHARD = 4_096
#: Sequences that a task gathers before it hands them on.
SLICE = 4_096
#: Ranges of shards written one after the other; a task writes so many shards of a range at most, unless there are
#: more shuffle partitions than that needs.
PASSES = 2
SHARDS_OF_TASK = 16
#: Id between documents; a rank file that uses it, or ids past 16 bits, is refused.
END = 50_256
END_ID = struct.pack("<I", END)
#: doc_id in the header of a sequence that starts in a document without one.
NO_ID = -(1 << 63)

HEADER = "<qIHI"
HEADER_SIZE = struct.calcsize(HEADER)
STRIDE = HEADER_SIZE + 2 * LENGTH + 1
RECORD = np.dtype(
    [("doc_id", "<i8"), ("start", "<u4"), ("n", "<u2"), ("crc", "<u4"), ("ids", f"V{2 * LENGTH}"), ("end", "V1")]
)
ROUNDS = 6


def _round(half: np.ndarray, key: int, k: int) -> np.ndarray:
    x = half + np.uint64((key + 0x9E3779B97F4A7C15 * (k + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slots(index: np.ndarray, total: int, key: int) -> np.ndarray:
    """A permutation of 0 .. total - 1, chosen by ``key``, at each index.

    The Feistel network permutes the smallest power of four that holds ``total``; a value that
    falls outside is permuted again until it lies inside, on average less than four times.
    """
    bits = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    half, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in range(ROUNDS):
            left, right = right, left ^ (_round(right, key, k) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= np.uint64(total)]
    return out.astype(np.int64)


class Cutter:
    """Cuts a stream of documents into sequences (doc_id, start, ids).

    doc_id and start say in which document, and how many tokens into it, the sequence begins.
    """

    def __init__(self, ranks: str, length: int = LENGTH):
        self.encoder = part_encoder(ranks)
        self.length = length
        self.rest = np.empty(0, dtype="<u2")
        self.begins: tuple[int | None, int] = (None, 0)

    def add(self, doc: int | None, text: str | None) -> Iterator[tuple[int | None, int, np.ndarray]]:
        ids = np.frombuffer(self.encoder.encode(text or "") + END_ID, dtype="<u4").astype("<u2")  # checked_ranks
        if not len(self.rest):
            self.begins = (doc, 0)
        room = self.length - len(self.rest)
        if len(ids) < room:
            self.rest = np.concatenate([self.rest, ids])
            return
        yield *self.begins, np.concatenate([self.rest, ids[:room]])
        while len(ids) - room >= self.length:
            yield doc, room, ids[room : room + self.length]
            room += self.length
        self.rest, self.begins = ids[room:], (doc, room)

    def end(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        if len(self.rest):
            yield *self.begins, self.rest
        self.rest = self.rest[:0]


def checked_ranks(ranks: str) -> str:
    """``ranks`` itself, if its ids fit two bytes and leave END free."""
    ids = read_ranks(ranks).values()
    if max(ids) > 0xFFFF or END in ids:
        raise ValueError(f"{ranks} has ids past 16 bits, or uses {END}, the id between documents")
    return ranks


def _record(doc: int | None, start: int, ids: np.ndarray) -> bytes:
    ids = ids.tobytes()
    return struct.pack(HEADER, NO_ID if doc is None else doc, start, len(ids) // 2, zlib.crc32(ids)) + ids


def sequences(docs: DataFrame, ranks: str) -> DataFrame:
    """``part``, ``place`` and the record of every sequence, cut through each partition in order."""
    checked_ranks(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, part, done = Cutter(ranks), TaskContext.get().partitionId(), 0

        def out(found: list[bytes]) -> pa.RecordBatch:
            nonlocal done
            place = pa.array(range(done, done + len(found)), pa.int64())
            done += len(found)
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(found), pa.int64()), place, pa.array(found, pa.binary())], names=["part", "place", "record"]
            )

        found = []
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for sequence in cutter.add(doc, text.as_py()):
                    found.append(_record(*sequence))
                    if len(found) == SLICE:
                        yield out(found)
                        found = []
        if found := [*found, *(_record(*sequence) for sequence in cutter.end())]:
            yield out(found)

    return docs.mapInArrow(run, "part long, place long, record binary")


def numbering(stored: DataFrame) -> tuple[DataFrame, int]:
    """``begin``, the sequences of earlier partitions, by ``part`` of a stored table of ``sequences``; and the sequences in all."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    counts = stored.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    begins = counts.select("part", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    begins = kept(begins, "begins")  # its size is known then, and decides how it is joined
    return begins.select("part", "begin"), begins.agg(F.sum("n")).first()[0] or 0


def records(stored: DataFrame, begins: DataFrame, total: int, key: int, first: int, end: int) -> DataFrame:
    """``slot`` and ``record`` of the stored sequences whose slots are ``first`` and more, but less than ``end``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = slots(batch.column(0).to_numpy(), total, key)
            here = np.flatnonzero((slot >= first) & (slot < end))
            yield pa.RecordBatch.from_arrays([pa.array(slot[here]), batch.column(1).take(pa.array(here))], names=["slot", "record"])

    numbered = stored.join(begins, "part").select((F.col("begin") + F.col("place")).alias("index"), "record")
    return numbered.mapInArrow(run, "slot long, record binary")


def write_shards(docs: DataFrame, ranks: str, key: int, path: str, per_shard: int = PER_SHARD) -> None:
    """Write the sequences of (doc_id, text) to ``path`` in training order.

    A null text is empty: it has the end id alone. A null doc_id is a document like any other,
    repeated rows are trained on repeatedly, a text of any length goes on over as many sequences as it
    takes, other columns are not looked at, and no rows write no shard. The numbering follows the
    input's partitions. A shard is read as one row, so ``per_shard`` bounds what a reader holds.

    The shards are written in ``PASSES`` ranges, each from the stored sequences and through a shuffle of its own, whose
    files go when the range is written.
    """
    spark = docs.sparkSession
    stored = kept(sequences(docs.select("doc_id", "text"), ranks), "sequences", compression="zstd")
    begins, total = numbering(stored)
    padded = F.rpad("record", STRIDE - 1, F.unhex(F.lit("00")))
    shards = max(1, -(-total // per_shard))
    bounds = sorted({shards * k // PASSES for k in range(PASSES + 1)})
    at_once = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for first, end in zip(bounds, bounds[1:]):
        tasks = min(end - first, max(at_once, -(-(end - first) // SHARDS_OF_TASK)))
        with shuffles_dropped(spark):
            (
                records(stored, begins, total, key, first * per_shard, end * per_shard)
                .withColumn("shard", F.floor(F.col("slot") / per_shard))
                .repartitionById(tasks, ((F.col("shard") - first) * tasks / (end - first)).cast("int"))  # whole shards, neighbours together
                .sortWithinPartitions("shard", "slot")
                .select("shard", padded.cast("string").alias("record"))  # bytes stay as they are
                .write.partitionBy("shard")
                .mode("append" if first else "error")
                .option("compression", "none")
                .text(path)
            )


SCHEMA = (
    "slot long, shard long, byte_offset long, doc_id long, start long, n_tokens long, "
    "ids_crc32 long, intact boolean"
)


def read_shards(spark: SparkSession, path: str, first_slot: int = 0, per_shard: int = PER_SHARD) -> DataFrame:
    """What each record from ``first_slot`` on says, and whether its ids have the crc32 it names."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    files = files.select("content", F.col("shard").cast("long").alias("shard"))
    files = files.filter(F.col("shard") >= first_slot // per_shard)
    names = [field.split()[0] for field in SCHEMA.split(", ")]

    def said(view: memoryview, shard: int, places: range) -> pa.RecordBatch:
        at = np.arange(places.start, places.stop) * STRIDE
        found = np.frombuffer(view[places.start * STRIDE : places.stop * STRIDE], RECORD)
        ends = (at + HEADER_SIZE + 2 * found["n"].astype(np.int64)).tolist()
        crc = np.array([zlib.crc32(view[a:b]) for a, b in zip((at + HEADER_SIZE).tolist(), ends)], np.int64)
        columns = [pa.array(found[name].astype(np.int64)) for name in ("start", "n", "crc")]
        doc = pa.array(found["doc_id"].astype(np.int64), mask=found["doc_id"] == NO_ID)
        slot, shard = np.arange(places.start, places.stop) + shard * per_shard, np.full(len(at), shard)
        return pa.RecordBatch.from_arrays(
            [*map(pa.array, (slot, shard, at)), doc, *columns, pa.array(crc == found["crc"])], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, shard in zip(batch.column(0), batch.column(1).to_pylist()):
                view = memoryview(data.as_buffer())
                places = range(max(first_slot - shard * per_shard, 0), len(view) // STRIDE)
                for k in range(0, len(places), SLICE):
                    yield said(view, shard, places[k : k + SLICE])

    return files.mapInArrow(run, SCHEMA)


def training_order(docs: DataFrame, ranks: str, key: int) -> DataFrame:
    """Write the shards to the shared folder and return what is read back from them."""
    spark = docs.sparkSession
    path = scratch_path(spark, "shards")
    write_shards(docs, ranks, key, path)
    if docs.isEmpty():
        return spark.createDataFrame([], SCHEMA)
    return read_shards(spark, path)

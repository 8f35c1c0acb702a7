"""Best-fit packing by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens. Only how many pieces have which length
matters for packing, and that is a table of at most ``capacity`` counts at any input size. From it
a bitset subset-sum programme picks, bin after bin, the fullest feasible combination of the lengths
still available; a combination is used again while its lengths last, since the next bin would find
the same. The plan (lengths, ranks and places) goes back to the cluster, where each piece finds its
place from its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmetrics.llm.common import kept
from tripmetrics.llm.tokens import part_encoder

CAPACITY = 2048
#: Rows that a task should rank at a time.
RANKED_TOGETHER = 50_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces_of(ids: bytes, capacity: int) -> Iterator[tuple[int, int, bytes]]:
    """(start, length, bytes) of each piece of a document; only the first may be short."""
    n = len(ids) // 4
    end = n % capacity or min(n, capacity)
    start = 0
    while start < n:
        yield start, end - start, ids[4 * start : 4 * end]
        start, end = end, end + capacity


def tokenised_pieces(
    docs: DataFrame, ranks: str, capacity: int = CAPACITY, vocabulary: str | None = None
) -> DataFrame:
    """One row for each piece of each document; a null text is empty and has the end id alone.

    Strings of the added tokens of ``vocabulary`` (a ``tokenizers`` file) have the ids it gives them.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = part_encoder(ranks, vocabulary)
        end = bytes(4)
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py() or "") + end
                for k, (start, length, part) in enumerate(pieces_of(ids, capacity)):
                    out.append((doc, k, start, length, zlib.crc32(part)))
            columns = list(zip(*out)) if out else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def fullest(counts: np.ndarray, room: int) -> dict[int, int]:
    """How often each length goes into ``room`` so that as little as possible stays free.

    Bit s of a set is on if some choice of the lengths seen so far adds up to s. Lengths come
    longest first and the search ends once the room can be filled whole, so long pieces go early.
    """
    reach, steps = 1, []
    whole = 1 << room
    for length in range(room, 0, -1):
        if not counts[length]:
            continue
        steps.append((length, reach))
        left, chunk = min(int(counts[length]), room // length), 1
        while left:
            take = min(chunk, left)
            reach |= (reach << (take * length)) & (2 * whole - 1)
            left -= take
            chunk *= 2
        if reach & whole:
            break
    best = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, before in reversed(steps):
        times = 0
        while not before >> (best - times * length) & 1:
            times += 1
        if times:
            chosen[length] = times
            best -= times * length
    return chosen


def packing_plan(counts: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, end rank, first sequence, times a sequence, offset).

    ``counts[l]`` is the number of pieces of length l; the capacity is the last index. Each
    combination uses up at least one length, so there are at most ``capacity`` of them.
    """
    capacity = len(counts) - 1
    left = counts.astype(np.int64).copy()
    used = np.zeros_like(left)
    plan, sequence = [], 0
    for longest in range(capacity, 0, -1):
        while left[longest]:
            left[longest] -= 1
            chosen = fullest(left, capacity - longest)
            left[longest] += 1
            chosen[longest] = chosen.get(longest, 0) + 1
            bins = min(int(left[length]) // times for length, times in chosen.items())
            at = 0
            for length, times in sorted(chosen.items(), reverse=True):
                first = int(used[length])
                plan.append((length, first, first + bins * times, sequence, times, at))
                used[length] += bins * times
                left[length] -= bins * times
                at += times * length
            sequence += bins
    return plan


def ranked(pieces: DataFrame, most: int) -> DataFrame:
    """Each piece with its rank among those of its length, from 0.

    A length that many pieces share is spread over buckets; a bucket's ranks start where the
    earlier buckets of that length end.
    """
    buckets = max(1, -(-most // RANKED_TOGETHER))
    spread = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    begins = (
        spread.groupBy("length", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("length", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_at"))
    )
    within = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    return spread.withColumn("_row", F.row_number().over(within)).join(
        begins, ["length", "_bucket"]
    ).withColumn("_rank", F.col("_at") + F.col("_row") - 1)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) with a sequence and a place in it.

    Places of a sequence are gapless from 0. Repeated rows are packed each on their own; a null
    doc_id is an id like any other. No pieces give no rows.
    """
    spark = pieces.sparkSession
    pieces = kept(pieces, "pieces")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
    plan = pd.DataFrame(
        packing_plan(counts), columns=["_length", "_first", "_end", "_sequence", "_times", "_offset"]
    ).astype("int64")
    places = spark.createDataFrame(
        plan,
        "_length long, _first long, _end long, _sequence long, _times long, _offset long",
    )
    step = F.col("_rank") - F.col("_first")
    return (
        ranked(pieces, int(counts.max()))
        .join(  # the plan has at most capacity combinations of at most 63 lengths each
            F.broadcast(places),
            (F.col("length") == F.col("_length"))
            & (F.col("_rank") >= F.col("_first"))
            & (F.col("_rank") < F.col("_end")),
        )
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("_sequence") + F.expr("(_rank - _first) div _times")).alias("sequence_id"),
            (F.col("_offset") + F.pmod(step, F.col("_times")) * F.col("length")).alias("offset"),
        )
    )


def pack_documents(
    docs: DataFrame, ranks: str, capacity: int = CAPACITY, vocabulary: str | None = None
) -> DataFrame:
    """Tokenise documents (doc_id, text) and pack them; other columns are not looked at."""
    return pack(tokenised_pieces(docs, ranks, capacity, vocabulary), capacity)

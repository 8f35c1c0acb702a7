"""SimHash near-duplicates by a grid join over segment bit counts.

A fingerprint is mapped to the bit counts of its 32 segments of two bits. The Manhattan distance of
two such vectors never exceeds the Hamming distance of the fingerprints. The grid has six
coordinates, blocks of five or six segments; vectors within distance 3 differ in at most three of
them, so they share a cell of one of the twenty subgrids that three coordinates span. What meets
in a cell is held against the lower bound and then compared exactly. Within a cell only links that
span its groups are kept, so a group of copies costs rows in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import kept, own_columns, unused
from tripmetrics.llm.components import components

SEED = 42
NEAR = 3
#: Words of a shingle.
SHINGLE = 3
#: Fingerprints of a cell that one task compares; larger cells are cut into pairs of blocks.
BLOCK = 4096
#: Longest cell whose pairs are all compared by shifting.
SHORT = 16

_SEGMENTS = 32
_COORDINATES = 6


def fingerprint(text: str | None) -> int:
    """SimHash of the word shingles of a text, as a signed 64-bit number; no words give 0."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and blanks only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = [a + b" " + b + b" " + c for a, b, c in zip(words, words[1:], words[2:])]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(shingles), 1 << 16):
        part = [digest(s, SEED) for s in shingles[at : at + (1 << 16)]]
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(shingles), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and bits of each row of (doc_id, text); a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [fingerprint(value.as_py()) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bits, pa.int64())], names=["doc_id", "bits"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, bits long")


def segment_counts(bits: Column) -> Column:
    """The segments' bit counts 0, 1, 2 written as 00, 01, 11.

    In this form the Manhattan distance of two vectors is the number of bits that differ.
    """
    odd = F.lit(0x5555555555555555)
    high = F.shiftrightunsigned(bits, 1)
    either = bits.bitwiseOR(high).bitwiseAND(odd)
    both = bits.bitwiseAND(high).bitwiseAND(odd)
    return either.bitwiseOR(F.shiftleft(both, 1))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def subgrids() -> list[int]:
    """Masks of the segments that span each subgrid."""
    ends = [round(_SEGMENTS * k / _COORDINATES) for k in range(_COORDINATES + 1)]
    blocks = [(1 << 2 * b) - (1 << 2 * a) for a, b in zip(ends, ends[1:])]
    return [_signed(sum(three)) for three in combinations(blocks, _COORDINATES - NEAR)]


def grid_cells(nodes: DataFrame) -> DataFrame:
    """``cell`` and ``bits``: each fingerprint in its cell of every subgrid."""
    counts = segment_counts(F.col("bits"))
    cells = F.array(*(F.xxhash64(F.lit(k), counts.bitwiseAND(F.lit(mask))) for k, mask in enumerate(subgrids())))
    return nodes.select("bits", F.explode(cells).alias("cell"))


def in_blocks(cells: DataFrame) -> DataFrame:
    """``task`` and ``bits``: the fingerprints to compare with each other.

    A cell of more than BLOCK fingerprints is cut into blocks, and each two of its blocks (and each
    with itself) are a task of their own, so no task meets an unbounded cell and no pair is lost.
    """
    full = (
        cells.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("bits"), F.col("blocks")).cast("int")
    return (
        cells.join(full, "cell")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("task"),
            "bits",
        )
    )


def _near(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """Lower bound first, then the exact distance of what is left."""
    found = np.bitwise_count(_thermometer(a) ^ _thermometer(b)) <= NEAR
    found[found] = np.bitwise_count((a ^ b)[found]) <= NEAR
    return found


def _thermometer(x: np.ndarray | np.uint64) -> np.ndarray:
    odd = np.uint64(0x5555555555555555)
    high = x >> np.uint64(1)
    return ((x | high) & odd) | ((x & high & odd) << np.uint64(1))


def spanning_links(bits: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect whatever is near in ``bits``, fewer than it has values."""
    links, rest = [], bits
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            at = reached.pop()
            near = _near(rest, at)
            for other in rest[near]:
                links.append((int(at), int(other)))
                reached.append(other)
            rest = rest[~near]
    return links


def near_links(tasks: DataFrame) -> DataFrame:
    """Links a, b between near fingerprints of a task, enough to connect all that are near."""

    def links_of(task: np.ndarray, bits: np.ndarray) -> list[tuple[int, int]]:
        starts = np.flatnonzero(np.r_[True, task[1:] != task[:-1]])
        lengths = np.diff(np.r_[starts, len(task)])
        long = lengths > SHORT
        found = [link for s, n in zip(starts[long], lengths[long]) for link in spanning_links(bits[s : s + n])]
        short = ~np.repeat(long, lengths)
        task, bits = task[short], bits[short]
        for shift in range(1, SHORT):
            at = np.flatnonzero(task[:-shift] == task[shift:])
            if not len(at):
                break
            at = at[_near(bits[at], bits[at + shift])]
            found += zip(bits[at].tolist(), bits[at + shift].tolist())
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(task: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
            links = np.array(links_of(task, bits.view(np.uint64)), dtype=np.uint64).reshape(-1, 2)
            links = np.unique(links, axis=0).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

        task, bits = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            task = np.r_[task, batch.column(0).to_numpy()]
            bits = np.r_[bits, batch.column(1).to_numpy()]
            if not len(task):
                continue
            open_at = int(np.searchsorted(task, task[-1]))  # sorted: the last task may go on
            if open_at:
                yield out(task[:open_at], bits[:open_at])
                task, bits = task[open_at:], bits[open_at:]
        if len(task):
            yield out(task, bits)

    return (
        tasks.repartition("task")
        .sortWithinPartitions("task", "bits")
        .mapInArrow(run, "a long, b long")
        .distinct()
    )


def fingerprint_components(nodes: DataFrame) -> DataFrame:
    """``node`` and ``root`` of each distinct fingerprint (bits) that is near another one."""
    return components(near_links(in_blocks(grid_cells(nodes))))


def _rooted(nodes: DataFrame) -> DataFrame:
    """``nodes`` (bits and more) with the root of each fingerprint's component."""
    linked = fingerprint_components(nodes.select("bits"))
    joined = nodes.join(linked, nodes["bits"] == linked["node"], "left")
    return kept(joined.select(*nodes.columns, F.coalesce("root", "bits").alias("root")), "roots")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of each row of (doc_id, text).

    Fingerprints link at three differing bits or fewer. component_id is the smallest doc_id that
    links reach, the row's own included. A null text has no words; texts without words have
    fingerprint zero and link like any other. Rows with a null doc_id take part and give no id: a
    component of such rows alone has a null component_id. Repeated rows stay repeated. Other
    columns are not looked at; no rows give no rows.
    """
    marked = kept(fingerprints(docs), "fingerprints")
    nodes = kept(marked.groupBy("bits").agg(F.min("doc_id").alias("least")), "nodes")
    rooted = _rooted(nodes)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_bits = rooted.join(least, "root").select("bits", "component_id")
    return marked.join(of_bits, "bits").select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates; all columns stay.

    That is the row with the smallest doc_id, rows without one last; of several rows with that id
    in the group the one with the smallest fingerprint, and of equal ones any.
    """
    bits, key, its_bits, its_key = (unused(docs, n) for n in ("_bits", "_key", "_its_bits", "_its_key"))

    @F.pandas_udf("long")
    def bits_of(text: pd.Series) -> pd.Series:
        return text.map(fingerprint)

    # Nondeterministic to the planner only: the join's null check would else go below as a second call, and every
    # task would run two Python workers, which stay beside each other for the stages that follow.
    marked = docs.withColumn(bits, bits_of.asNondeterministic()("text")).withColumn(
        key, F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    )
    nodes = kept(
        marked.groupBy(F.col(bits).alias("bits")).agg(F.min(F.struct(F.col(key).alias("key"), F.col(bits).alias("bits"))).alias("least")),
        "nodes",
    )
    first = _rooted(nodes).groupBy("root").agg(F.min("least").alias("first"))
    first = first.select(F.col("first.bits").alias(its_bits), F.col("first.key").alias(its_key))
    return (
        marked.join(first, (F.col(bits) == F.col(its_bits)) & (F.col(key) == F.col(its_key)))
        .dropDuplicates([bits, key])
        .select(*own_columns(docs))
    )

"""Packing as a cutting-stock problem, by column generation.

A sequence has at most ``CAPACITY`` tokens and is padded to that unless its length is a power of two.
Documents longer than a sequence fill whole ones; what is left of them, and all shorter documents, are
rests of 1 to ``CAPACITY - 1`` tokens. For packing only the histogram of rest lengths matters, a table of
bounded size at any input. A linear program covers it by patterns (how often each length goes into one
sequence) at the least cost in padded tokens; a knapsack programme finds the pattern that the dual
prices make most worthwhile, until none is worth anything. Patterns are rounded down and used that often,
the remainder is filled by the same knapsack, and what no pattern takes is cut into powers of two,
which need no padding. The plan goes back to the cluster as ranges of ranks: rests are numbered by length,
and each finds its sequence and place there from its number alone.
"""

from __future__ import annotations

import zlib

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import kept, numbered
from tripmetrics.llm.tokens import part_encoder

CAPACITY = 1024
#: What one more sequence, or one more cut of a document, costs, in padded tokens.
PIECE_COST = 1
#: The linear program ends once its cost is proven to be within this share of the least.
GAP = 0.0002
#: Patterns that one run of the knapsack may add, and pivots between fresh inverses of the basis.
AT_ONCE, REFRESH = 12, 256
#: Runs of the knapsack within which the cost has to fall by a tenth of ``GAP``, else the program ends.
PATIENCE = 40
#: Share of the ideal prices in those at which patterns are looked for.
TOWARDS = 0.7

Pattern = dict[int, int]


# ------------------------------------------------------------------- the plan


def padded(tokens: int, capacity: int) -> int:
    return tokens if tokens & (tokens - 1) == 0 else capacity


def powers(length: int) -> list[int]:
    """The powers of two that add up to a length, largest first."""
    return [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]


class Knapsack:
    """For each sum of tokens the choice of rests worth most, none taken more often than there are."""

    def __init__(self, lengths: np.ndarray, bounds: np.ndarray, prices: np.ndarray, capacity: int):
        self.steps: list[tuple[int, int, int]] = []
        for i, (length, bound) in enumerate(zip(lengths.tolist(), bounds.tolist())):
            left, chunk = min(bound, capacity // length), 1
            while left > 0:  # 1, 2, 4 and so on of them, so that any number can be made up
                take = min(chunk, left)
                self.steps.append((i, take, take * length))
                left, chunk = left - take, 2 * chunk
        self.lengths = lengths
        self.value = value = np.full(capacity + 1, -np.inf)
        value[0] = 0.0
        self.took = np.zeros((len(self.steps), capacity + 1), dtype=bool)
        for took, (i, take, size) in zip(self.took, self.steps):
            better = value[: capacity + 1 - size] + prices[i] * take
            np.greater(better, value[size:], out=took[size:])
            np.maximum(better, value[size:], out=value[size:])

    def choice(self, tokens: int) -> dict[int, int]:
        """How often each rest (by its index) goes into the best choice of so many tokens."""
        found: dict[int, int] = {}
        for k in range(len(self.steps) - 1, -1, -1):
            if self.took[k, tokens]:
                i, take, size = self.steps[k]
                found[i] = found.get(i, 0) + take
                tokens -= size
        return found


def costs(capacity: int) -> np.ndarray:
    """Cost of a sequence by its tokens; the empty one is never worth having."""
    out = np.array([padded(s, capacity) + PIECE_COST for s in range(capacity + 1)], dtype=float)
    out[0] = np.inf
    return out


def cut_costs(lengths: np.ndarray) -> np.ndarray:
    """Cost of cutting a rest into powers of two."""
    return np.array([n + PIECE_COST * n.bit_count() for n in lengths.tolist()], dtype=float)


def fullest(lengths: np.ndarray, bounds: np.ndarray, capacity: int) -> dict[int, int]:
    """The sequence that holds the longest rest with the least padding, of equal ones that with the
    longest rests beside it; empty if cutting them costs no more."""
    longest = len(lengths) - 1
    room = capacity - int(lengths[longest])
    bounds = bounds.copy()
    bounds[longest] -= 1
    fits = (lengths <= room) & (bounds > 0)
    small = lengths[fits]
    sack = Knapsack(small, bounds[fits], small + 2 * (small / capacity) ** 2, room)
    tokens = int((sack.value - costs(capacity)[capacity - room :]).argmax())
    rows = np.flatnonzero(fits)
    chosen = {int(rows[i]): k for i, k in sack.choice(tokens).items()}
    chosen[longest] = chosen.get(longest, 0) + 1
    cut = cut_costs(lengths[list(chosen)]) @ np.array(list(chosen.values()))
    return chosen if cut > costs(capacity)[capacity - room + tokens] else {}


@dataclass
class Column:
    cost: float
    rows: np.ndarray
    times: np.ndarray
    cut: bool = False


def first_basis(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[Column]:
    """Columns to begin with, one for each length: the fullest pattern for the longest rests that are left, used
    until one of its lengths runs out, which no later pattern has. Other lengths are cut."""
    left = counts.astype(float)
    cut = cut_costs(lengths)
    basis = [Column(c, np.array([i]), np.array([1.0]), True) for i, c in enumerate(cut.tolist())]
    cost_of = costs(capacity)
    while len(there := np.flatnonzero(left)):
        chosen = fullest(lengths[there], np.ceil(left[there]).astype(np.int64), capacity)
        if not chosen:  # the longest is cut
            left[there[-1]] = 0.0
            continue
        rows, times = there[list(chosen)], np.array(list(chosen.values()), dtype=float)
        fewest = int((left[rows] / times).argmin())
        left[rows] -= times * (left[rows[fewest]] / times[fewest])
        left[rows[fewest]] = 0.0
        left[left < 1e-9] = 0.0
        basis[rows[fewest]] = Column(cost_of[int(lengths[rows] @ times)], rows, times)
    return basis


class Basis:
    """Columns, how often each is used to meet a demand, and the prices they give the lengths."""

    def __init__(self, columns: list[Column], demand: np.ndarray):
        self.columns, self.demand, self.pivots = columns, demand, 0
        m = len(columns)
        matrix = np.zeros((m, m))
        for k, column in enumerate(columns):
            matrix[column.rows, k] = column.times
        self.inverse = np.linalg.inv(matrix)
        self.used = self.inverse @ demand
        self.prices = np.array([c.cost for c in columns]) @ self.inverse

    def enter(self, column: Column) -> bool:
        """Take a column in for another if that lowers the cost."""
        gain = self.prices[column.rows] @ column.times - column.cost
        if gain <= 1e-9 * len(self.columns):
            return False
        step = self.inverse[:, column.rows] @ column.times
        ratio = np.full(len(step), np.inf)
        can = step > 1e-9
        ratio[can] = np.maximum(self.used[can], 0.0) / step[can]
        most = ratio.min()
        out = int(np.where(ratio <= most * (1 + 1e-12), step, 0.0).argmax())
        self.used -= most * step
        self.used[out] = most
        row = self.inverse[out] / step[out]
        moving = np.flatnonzero(np.abs(step) > 1e-14)
        self.inverse[moving] -= np.outer(step[moving], row)
        self.inverse[out] = row
        self.prices = self.prices - gain * row
        self.columns[out] = column
        self.pivots += 1
        return True

    def cost(self) -> float:
        return float(self.prices @ self.demand)


def linear_program(
    lengths: np.ndarray, counts: np.ndarray, capacity: int, gap: float = GAP
) -> list[tuple[Column, float]]:
    """Columns of a basis and how often each is used, at a cost within ``gap`` of the least.

    The revised simplex method; columns are made as they are needed. No sequence costs less than its
    tokens and its share of a full sequence, which bounds the least cost from below, and so do prices at which
    no pattern is worth more than it costs. Patterns are looked for at prices between those of the
    basis and that bound's, which keeps them from swinging; what they are worth is told by the basis's own.
    """
    m = len(lengths)
    cost_of, cut = costs(capacity), cut_costs(lengths)
    ideal = lengths * (1 + PIECE_COST / capacity)
    basis = Basis(first_basis(lengths, counts, capacity), counts)
    # A little more of everything, a different little of each, so that no column stands at zero: pivots
    # there would change the prices for nothing, again and again.
    more = np.random.default_rng(0).uniform(0.01, 0.05, m)
    demand = np.zeros(m)
    for column, times in zip(basis.columns, np.maximum(basis.used, 0.0) + more):
        demand[column.rows] += column.times * times
    basis = Basis(basis.columns, demand)
    least, towards, falling = float(ideal @ demand), TOWARDS, [basis.cost()]
    while falling[-1] > least * (1 + gap):
        if len(falling) > PATIENCE and falling[-1] > (1 - gap / 10) * falling[-PATIENCE]:
            break
        moved = 0
        for i in np.argsort(cut - basis.prices)[:AT_ONCE].tolist():
            moved += basis.enter(Column(cut[i], np.array([i]), np.array([1.0]), True))
        between = towards * ideal + (1 - towards) * basis.prices
        sack = Knapsack(lengths, counts, between, capacity)
        worth = max(1.0, float((sack.value / cost_of).max()), float((between / cut).max()))
        least = max(least, float(between @ demand) / worth)
        gains = sack.value - cost_of
        for tokens in np.argsort(-gains, kind="stable")[:AT_ONCE].tolist():
            if np.isfinite(gains[tokens]):
                pattern = sack.choice(tokens)
                times = np.fromiter(pattern.values(), dtype=float)
                moved += basis.enter(Column(cost_of[tokens], np.fromiter(pattern, dtype=np.int64), times))
        if not moved and towards == 0:  # no pattern is worth anything: the least cost
            break
        towards = TOWARDS if moved else (towards / 2 if towards > 0.05 else 0.0)
        if basis.pivots >= REFRESH:
            basis = Basis(basis.columns, demand)
        falling.append(basis.cost())
    return list(zip(basis.columns, basis.used.tolist()))


def patterns(counts: np.ndarray) -> tuple[list[tuple[Pattern, int]], np.ndarray]:
    """Patterns with how many sequences follow each, and what is left to be cut.

    ``counts[l]`` is the number of rests of length l; the capacity is the last index.
    """
    capacity = len(counts) - 1
    left = counts.astype(np.int64).copy()
    out: list[tuple[Pattern, int]] = []

    def use(pattern: Pattern, most: int) -> int:
        times = min([most, *(int(left[n]) // k for n, k in pattern.items())])
        if times > 0:
            out.append((pattern, times))
            for n, k in pattern.items():
                left[n] -= times * k
        return max(times, 0)

    use({capacity: 1}, int(left[capacity]))
    lengths = np.flatnonzero(left)
    if not len(lengths):
        return out, left
    solved = []
    for column, amount in linear_program(lengths, left[lengths], capacity):
        if not column.cut and amount > 1e-6:
            pattern = {int(lengths[i]): int(k) for i, k in zip(column.rows, column.times)}
            solved.append((amount, pattern))
    again = [(amount - use(pattern, int(amount + 1e-6)), pattern) for amount, pattern in solved]
    for amount, pattern in sorted(again, key=lambda x: (-x[0], sorted(x[1].items()))):
        if amount > 0.5:
            use(pattern, 1)
    # What rounding left over: the fullest sequences of what there is, and cuts where those cost no more.
    cut = np.zeros_like(left)
    while len(lengths := np.flatnonzero(left)):
        chosen = fullest(lengths, left[lengths], capacity)
        if chosen:
            use({int(lengths[i]): k for i, k in chosen.items()}, int(left.max()))
        else:
            cut[lengths[-1]], left[lengths[-1]] = left[lengths[-1]], 0
    return out, cut


@dataclass
class Plan:
    """Where the rests go, by their number in order of length.

    Rests from ``begin[i]`` up to the next begin have one length: so many of them, ``times[i]``, lie side
    by side from ``offset[i]`` in sequence ``sequence[i]``, the next so many in the next sequence. Rests
    that are cut (``times`` 0) have a place for each piece in ``cuts``.
    """

    begin: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    cuts: dict[int, list[tuple[int, int]]]


def plan(counts: np.ndarray) -> Plan:
    """A plan for ``counts[l]`` rests of each length l; the capacity is the last index."""
    capacity = len(counts) - 1
    chosen, cut = patterns(counts)
    at = np.concatenate([[0], np.cumsum(counts)])[:-1]  # number of the next rest of each length
    rows: list[tuple[int, int, int, int]] = []
    sequence = 0
    for pattern, repeated in chosen:
        offset = 0
        for n, k in sorted(pattern.items(), reverse=True):
            rows.append((int(at[n]), k, sequence, offset))
            at[n] += k * repeated
            offset += n * k
        sequence += repeated
    # Powers of two, largest first, fill sequences to the brim; the last ones follow the bits of what is left.
    units = sorted(
        ((size, number, k) for n in np.flatnonzero(cut).tolist() for number in range(int(at[n]), int(at[n] + cut[n]))
         for k, size in enumerate(powers(n))),
        key=lambda unit: (-unit[0], unit[1:]),
    )
    total = sum(size for size, _, _ in units)
    cuts: dict[int, list[tuple[int, int]]] = {}
    room, offset = 0, 0
    for size, number, _ in units:
        if offset == room:
            sequence += room > 0
            room, offset = capacity if total >= capacity else powers(total)[0], 0
            total -= room
        cuts.setdefault(number, []).append((sequence, offset))
        offset += size
    rows += ((number, 0, 0, 0) for number in cuts)
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return Plan(*table.T, cuts)


# ----------------------------------------------------------------- the pieces

RESTS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, cut_crcs array<long>"


def rests(docs: DataFrame, ranks: str, vocabulary: str | None, capacity: int) -> DataFrame:
    """Whole sequences and the rest of each document; a null text is empty and has the end id alone.

    ``cut_crcs`` are the checksums of the pieces that a rest would be cut into.
    """

    def cut(ids: bytes, doc: int | None) -> Iterator[tuple]:
        n = len(ids) // 4
        for start in range(0, n, capacity):
            part = ids[4 * start : 4 * (start + capacity)]
            length = len(part) // 4
            crc, pieces, at = zlib.crc32(part), [], 0
            if length & (length - 1):
                for size in powers(length):
                    pieces.append(zlib.crc32(part[4 * at : 4 * (at + size)]))
                    at += size
            yield doc, start, length, crc, n, pieces or [crc]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = part_encoder(ranks, vocabulary), bytes(4)
        kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())]
        names = [field.split()[0] for field in RESTS.split(", ")]
        for batch in batches:
            rows = [
                row
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1))
                for row in cut(encoder.encode(text.as_py() or "") + end, doc)
            ]
            columns = zip(*rows) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, RESTS)


PLACED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def placed(ranked: DataFrame, found: Plan) -> DataFrame:
    """Every rest at its place, or its pieces at theirs. The plan is of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in PLACED.split(", ")]
        for batch in batches:
            *whole, crcs, number = batch.columns
            row = number.to_numpy()
            length = whole[2].to_numpy()
            i = np.searchsorted(found.begin, row, side="right") - 1
            times = found.times[i]
            uncut = times > 0
            step = row - found.begin[i]
            sequence = found.sequence[i] + step // np.maximum(times, 1)
            offset = found.offset[i] + step % np.maximum(times, 1) * length
            keep = pa.array(uncut)
            yield pa.RecordBatch.from_arrays(
                [c.filter(keep) for c in (*whole, pa.array(sequence), pa.array(offset))], names=names
            )
            pieces: list[tuple] = []
            for k in np.flatnonzero(~uncut).tolist():
                doc, start, n, _, tokens = (c[k].as_py() for c in whole)
                for size, crc, place in zip(powers(n), crcs[k].as_py(), found.cuts[int(row[k])]):
                    pieces.append((doc, start, size, crc, tokens, *place))
                    start += size
            if pieces:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pieces)], names=names)

    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "cut_crcs", "number")
    return ranked.select(*columns).mapInArrow(run, PLACED)


def pack_documents(
    docs: DataFrame, ranks: str, vocabulary: str | None = None, capacity: int = CAPACITY
) -> DataFrame:
    """Tokenise documents (doc_id, text) and pack them; other columns are not looked at.

    A null or empty text is its end id alone; texts of any length are cut into whole sequences and one
    rest. A null doc_id is an id like any other, repeated rows are packed each on their own, and rests
    of one length are ranked by doc_id (nulls first), start and checksum, so ties only swap equal
    pieces. No rows give no rows.
    """
    if capacity & (capacity - 1):
        raise ValueError("the capacity has to be a power of two")
    found = kept(rests(docs, ranks, vocabulary, capacity), "rests")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in found.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
    if not counts.any():
        return docs.sparkSession.createDataFrame([], PLACED)
    ranked = numbered(found, "number", "length", "doc_id", "start", "ids_crc32")
    return placed(ranked, plan(counts))

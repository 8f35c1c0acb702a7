"""Byte-level BPE as a monoid: encodings of neighbours join to the encoding of the whole.

Two levels have the same shape. A text is halved down to short spans that a scanner cuts into
matches of the pattern; a match is halved down to short byte strings that are merged directly.
Neighbours are joined by encoding a window around their seam anew, and the window grows until what
lies outside it provably stays:

* Matches. The scanner has no memory: a match depends on where it starts and on the text up to one
  character past the character behind it. So a match of the left side stays if at least two
  characters of that side follow it, and once the window's matches end where a match of the right
  side ends, with two characters of the window to come, all later matches of the right side stay.
* Tokens. Merges never cross from one token into the next if and only if each two neighbouring
  tokens, merged on their own, come out as themselves. So tokens outside the window stay once the
  pair at either edge does.

Decoding concatenates the bytes of the halves up the same tree.
"""

from __future__ import annotations

import hashlib
import heapq

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex

from pyspark.sql import DataFrame

from tripmetrics.llm.tokens import PATTERN, read_ranks

#: Longest span (characters) and byte string that are encoded without halving.
SPAN = 4096
PIECE = 24
#: Short matches remembered in each Python worker.
REMEMBERED = 400_000

DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class TreeCodec:
    """Encoder and decoder for one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.digits_of = [str(k) for k in range(len(self.bytes_of))]
        self._scan = regex.compile(pattern).findall
        self._known: dict[str, tuple[int, ...]] = {}

    # Tokens of one match

    def merge(self, data: bytes) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until no pair has a rank."""
        ranks = self.ranks
        if data in ranks:
            return [ranks[data]]
        parts = [data[i : i + 1] for i in range(len(data))]
        if len(parts) > 4 * PIECE:
            return self._merge_long(parts)
        pairs = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, rank in enumerate(pairs):
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                return [ranks[part] for part in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at])
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1])

    def _merge_long(self, parts: list[bytes | None]) -> list[int]:
        """The same with a heap and linked neighbours, for windows that had to grow far."""
        ranks, n = self.ranks, len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or ranks.get(parts[i] + parts[j]) != rank:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get(parts[i] + parts[after[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0:
                p = before[i]
                if (r := ranks.get(parts[p] + parts[i])) is not None:
                    heapq.heappush(heap, (r, p))
        return [ranks[part] for part in parts if part is not None]

    def _stays(self, a: int, b: int) -> bool:
        return self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right:
            return left + right
        width = 1
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            window = self.merge(self.decode(left[a:]) + self.decode(right[:b]))
            if (a == 0 or self._stays(left[a - 1], window[0])) and (
                b == len(right) or self._stays(window[-1], right[b])
            ):
                return left[:a] + window + right[b:]
            width *= 2

    def piece(self, data: bytes) -> list[int]:
        if len(data) <= PIECE:
            return self.merge(data)
        half = len(data) // 2
        return self.join_tokens(self.piece(data[:half]), self.piece(data[half:]))

    # Matches of a text

    def join_matches(self, left: list[str], right: list[str]) -> list[str]:
        if not left or not right:
            return left + right
        a, seam = len(left), 0
        while a and seam < 2:
            a -= 1
            seam += len(left[a])
        head, width = "".join(left[a:]), 1
        while True:
            b = min(len(right), width)
            window = head + "".join(right[:b])
            matches = self._scan(window)
            if b == len(right):
                return left[:a] + matches
            ends, at = {}, len(head)
            for k, match in enumerate(right[:b]):
                at += len(match)
                ends[at] = k + 1
            at = 0
            for k, match in enumerate(matches):
                at += len(match)
                if at > len(window) - 2:
                    break
                if at in ends:
                    return left[:a] + matches[: k + 1] + right[ends[at] :]
            width *= 2

    def matches(self, text: str) -> list[str]:
        if len(text) <= SPAN:
            return self._scan(text)
        half = len(text) // 2
        return self.join_matches(self.matches(text[:half]), self.matches(text[half:]))

    def _learn(self, match: str) -> tuple[int, ...]:
        ids = tuple(self.piece(match.encode()))
        if len(match) <= 2 * PIECE:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            self._known[match] = ids
        return ids

    # Whole texts

    def encode(self, text: str) -> list[int]:
        known, learn = self._known.get, self._learn
        return list(chain.from_iterable([known(m) or learn(m) for m in self.matches(text)]))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= SPAN:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])

    def digits(self, ids: list[int]) -> str:
        return " ".join(map(self.digits_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str) -> TreeCodec:
    """One codec for each Python worker and rank file."""
    return TreeCodec(read_ranks(path))


def _batches(docs: DataFrame, row, names: list[str], kinds: list, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [row(value.as_py()) for value in batch.column(1)]
            columns = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names])

    return docs.mapInArrow(run, schema)


def encode_documents(docs: DataFrame, ranks: str) -> DataFrame:
    """doc_id and ids (array of int) of each row of (doc_id, text), in no matter what order.

    A null or empty text has no ids. A null doc_id stays null, repeated rows stay repeated, and
    other columns are not looked at.
    """
    return _batches(
        docs.select("doc_id", "text"),
        lambda text: (codec(ranks).encode(text or ""),),
        ["ids"],
        [pa.list_(pa.int32())],
        "doc_id long, ids array<int>",
    )


def decode_documents(encoded: DataFrame, ranks: str) -> DataFrame:
    """doc_id and bytes of each row of (doc_id, ids); null ids give no bytes."""
    return _batches(
        encoded.select("doc_id", "ids"),
        lambda ids: (codec(ranks).decode(ids or []),),
        ["bytes"],
        [pa.binary()],
        "doc_id long, bytes binary",
    )


def round_trip_digests(docs: DataFrame, ranks: str) -> DataFrame:
    """Number and digest of each text's ids, and the digest of their bytes, in one pass."""

    def row(text: str | None) -> tuple[int, str, str]:
        tree = codec(ranks)
        ids = tree.encode(text or "")
        return (
            len(ids),
            hashlib.sha256(tree.digits(ids).encode()).hexdigest(),
            hashlib.sha256(tree.decode(ids)).hexdigest(),
        )

    return _batches(
        docs.select("doc_id", "text"),
        row,
        ["n_tokens", "ids_sha256", "decoded_sha256"],
        [pa.int64(), pa.string(), pa.string()],
        DIGESTS,
    )

"""Language-model scoring by cross-entropy difference.

Two bigram models of words, one of the target documents and one of all documents as background, share
one vocabulary: every word of all documents, however rare. Both are counted over whole texts and
smoothed alike, so they differ in nothing but their corpus. A document's score is the mean over its words
of the target model's loss less the background model's: the lower, the more it reads like the target.

What is counted grows with the corpus and is never in one place. Documents are dealt into blocks of a
bounded size. A block sends each of its pairs and words once, with its own counts, packed by ranges of keys;
counts are summed range by range, so a key has at most one count for each block, however frequent it is;
and the sums come back to each block in the order in which it sent its keys. Keys are 64-bit hashes of words
and pairs of words: two of them are taken for one with a chance of 1 in 2^64. Blocks and ranges both grow
with the input, so beyond some terabytes of text larger blocks keep what they exchange from falling into crumbs.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Weight of the bigram against the unigram.
LAMBDA = 0.8
#: Words that the shared prior, the unigrams of all documents, counts for in either model.
PRIOR = 1000
#: Bytes of text of a block on average; a text is never cut, so a longer one makes its block longer.
BLOCK_BYTES = 16 << 20

#: Odd factors and offsets that keep the keys of pairs, words and contexts apart.
PAIR, WORD, CONTEXT = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
START, TOTAL = (np.uint64(k) for k in (0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63))
#: What a block is told: the counts of a range of keys (``range``, ``data``), or a document of the target
#: (``row``, ``doc_id``, no data).
FACTS = "block long, range long, row long, doc_id long, data binary"
SCHEMA = "doc_id long, n_words long, target_loss double, background_loss double, score double"


def packed(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit integers, byte by byte of all their numbers, so that what is small packs well."""
    raw = b"".join(c.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpacked(data: bytes, columns: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    turned = raw.reshape(columns, 8, -1).transpose(0, 2, 1)
    return np.ascontiguousarray(turned).view("<u8").reshape(columns, -1)


def block_number(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return -(-size // block_bytes) or 1


def dealt(docs: DataFrame, blocks: int) -> DataFrame:
    """``block``, ``row``, doc_id and the bytes of every text; rows are dealt by number, so no content is a hot block."""
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("binary").alias("text")
    )
    return numbered.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"), "row", "doc_id", "text")


def marks(rows: DataFrame, target: DataFrame) -> DataFrame:
    """A row of FACTS for each document of the target: its row number and doc_id. No text is shuffled for it."""
    # The ids grow with the corpus, so they are joined by a shuffle at every size, never broadcast.
    ids = target.select(F.col("doc_id").alias("_id")).filter("_id is not null").distinct().hint("merge")
    found = rows.select("block", "row", "doc_id").join(ids, F.col("doc_id") == F.col("_id"))
    return found.select(
        F.col("block").alias("block"),
        F.lit(None).cast("long").alias("range"),
        F.col("row").alias("row"),
        F.col("_id").alias("doc_id"),
        F.lit(None).cast("binary").alias("data"),
    )


class Block:
    """The words of a block as places in its own list of words, and its counts of pairs, words and contexts."""

    def __init__(self, texts: pa.Table, marked: pa.Table):
        order = np.argsort(texts["row"].to_numpy(), kind="stable")
        texts = texts.take(order)
        row, self.doc_id = texts["row"].to_numpy(), texts["doc_id"].combine_chunks()
        target = dict(zip(marked["row"].to_pylist(), marked["doc_id"].to_pylist()))
        flags = np.array([r in target for r in row.tolist()], dtype=bool)
        for r, doc in zip(row.tolist(), self.doc_id.to_pylist()):
            if target.get(r, doc) != doc:
                raise ValueError("the documents come in another order each time they are read")
        index: dict[bytes, int] = {}
        parts = []
        for text in texts["text"]:
            split = (text.as_py() or b"").lower().split()
            parts.append(np.array([index.setdefault(w, len(index)) for w in split], dtype=np.int64))
        self.lengths = np.array([len(p) for p in parts], dtype=np.int64)
        word = np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)
        m = len(index)
        before = np.empty_like(word)
        before[1:] = word[:-1]
        begins = (np.cumsum(self.lengths) - self.lengths)[self.lengths > 0]
        before[begins] = m  # the start of a text
        flag = np.repeat(flags, self.lengths)
        pairs, self.place = np.unique(before * max(m, 1) + word, return_inverse=True)
        self.before, self.word = pairs // max(m, 1), pairs % max(m, 1)
        hashes = np.array([*map(xxhash.xxh64_intdigest, index), START], dtype=np.uint64)
        self.sizes = len(pairs), m, m + 1, 1
        self.keys = np.concatenate(
            [hashes[self.before] * PAIR + hashes[self.word], hashes[:m] * WORD + START, hashes * CONTEXT + TOTAL, [TOTAL]]
        )
        self.order = np.argsort(self.keys, kind="stable")

        def tally(chosen: slice | np.ndarray) -> np.ndarray:
            found = [
                np.bincount(values[chosen], minlength=size)
                for values, size in zip((self.place, word, before), self.sizes)
            ]
            return np.concatenate([*found, [found[0].sum()]]).astype(np.int64)

        self.n, self.t = tally(slice(None)), tally(flag)

    def sent(self, ranges: int) -> list[tuple[int, bytes]]:
        """The keys, as distances in ascending order, and their counts, for each range that holds any."""
        keys, n, t = (c[self.order] for c in (self.keys, self.n, self.t))
        begins = np.searchsorted(keys, np.array([(k << 64) // ranges for k in range(ranges)], dtype=np.uint64))
        ends = np.append(begins[1:], len(keys))
        return [
            (k, packed(np.diff(keys[i:j], prepend=np.uint64(0)), n[i:j], t[i:j]))
            for k, (i, j) in enumerate(zip(begins.tolist(), ends.tolist()))
            if i < j
        ]

    def take(self, facts: pa.Table) -> None:
        """Put the counts of all blocks in place of this block's own."""
        data = [unpacked(d, 2) for d in facts.sort_by("range")["data"].to_pylist()]
        self.n[self.order], self.t[self.order] = np.concatenate(data, axis=1).astype(np.int64)

    def losses(self) -> tuple[np.ndarray, np.ndarray]:
        """-log2 P(word | word before) of every pair of the block, under the target and the background."""
        cuts = np.cumsum(self.sizes)[:-1]
        _, word, _, total = np.split(self.n, cuts)
        prior = word[self.word] / total[0] if total[0] else word[self.word]

        def loss(counts: np.ndarray) -> np.ndarray:
            pair, word, context, total = np.split(counts, cuts)
            single = (word[self.word] + PRIOR * prior) / (total[0] + PRIOR)
            seen = context[self.before]
            mixed = LAMBDA * pair / np.maximum(seen, 1) + (1 - LAMBDA) * single
            return -np.log2(np.where(seen > 0, mixed, single))

        return loss(self.t), loss(self.n)


def _nothing(schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    fields = [field.split() for field in schema.split(", ")]
    return pa.table({name: pa.array([], kinds[kind]) for name, kind in fields})


def _facts(block: list[int], ranges: list[int], data: list[bytes]) -> pa.Table:
    none = pa.nulls(len(data), pa.int64())
    columns = [pa.array(block, pa.int64()), pa.array(ranges, pa.int64()), none, none, pa.array(data, pa.binary())]
    return pa.table(columns, names=[field.split()[0] for field in FACTS.split(", ")])


def _count(ranges: int):
    def run(texts: pa.Table, marked: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _nothing(FACTS)
        sent = Block(texts, marked).sent(ranges)
        return _facts([texts["block"][0].as_py()] * len(sent), *map(list, zip(*sent)))

    return run


def _sum(sent: pa.Table) -> pa.Table:
    """The counts of a range of keys over all blocks, for each block in the order of its keys."""
    data = [unpacked(d, 3) for d in sent["data"].to_pylist()]
    keys = np.concatenate([np.cumsum(d[0], dtype=np.uint64) for d in data])
    _, place = np.unique(keys, return_inverse=True)
    cuts = np.cumsum([d.shape[1] for d in data])[:-1]
    sums = []
    for side in (1, 2):
        every = np.bincount(place, weights=np.concatenate([d[side] for d in data]))
        sums.append(np.split(every[place].astype(np.uint64), cuts))
    return _facts(sent["block"].to_pylist(), sent["range"].to_pylist(), [packed(n, t) for n, t in zip(*sums)])


def _score(texts: pa.Table, facts: pa.Table) -> pa.Table:
    if not texts.num_rows:
        return _nothing(SCHEMA)
    sums = pc.is_valid(facts["data"])
    block = Block(texts, facts.filter(pc.invert(sums)))
    block.take(facts.filter(sums))
    doc = np.repeat(np.arange(len(block.lengths)), block.lengths)
    n = np.maximum(block.lengths, 1)
    a, b = (np.bincount(doc, weights=loss[block.place], minlength=len(n)) / n for loss in block.losses())
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    return pa.table([block.doc_id, block.lengths, a, b, a - b], names=names)


def loss_difference(docs: DataFrame, target: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Score every row of (doc_id, text); the documents that ``target`` (doc_id) names are the target.

    A null or empty text has no words and scores 0 under both models. A null doc_id is scored and
    never in the target; repeated rows count each time; an empty target has the prior alone. A text is
    scored whole, however long: it is a block's memory. Other columns are not looked at, and no rows give
    no rows. Results do not depend on how rows are dealt into blocks; ``docs`` should read files, as its rows
    are numbered in the order they are read, and another order at a second reading is an error.
    """
    docs = docs.select("doc_id", "text")
    blocks = block_number(docs, block_bytes)
    rows = dealt(docs, blocks)
    marked = marks(rows, target)
    counts = rows.groupBy("block").cogroup(marked.groupBy("block")).applyInArrow(_count(2 * blocks), FACTS)
    facts = counts.groupBy("range").applyInArrow(_sum, FACTS).unionByName(marked)
    return rows.groupBy("block").cogroup(facts.groupBy("block")).applyInArrow(_score, SCHEMA)


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    list_filter(string_split_regex(translate(coalesce(text, ''), '{ascii_uppercase}',
      '{ascii_lowercase}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), w AS (
  SELECT row_id, doc_id, unnest(words) AS b, generate_subscripts(words, 1) AS i FROM d
), pairs AS (
  SELECT row_id, doc_id, b, coalesce(lag(b) OVER (PARTITION BY row_id ORDER BY i), '') AS a FROM w
), good AS (
  SELECT DISTINCT doc_id, true AS is_good FROM labels WHERE quality = 1 AND doc_id IS NOT NULL
), counts AS (
  SELECT a, b, count(*)::DOUBLE AS n, count(is_good)::DOUBLE AS t
  FROM pairs LEFT JOIN good USING (doc_id) GROUP BY a, b
), befores AS (
  SELECT a, sum(n) AS n, sum(t) AS t FROM counts GROUP BY a
), singles AS (
  SELECT b, sum(n) AS n, sum(t) AS t FROM counts GROUP BY b
), totals AS (
  SELECT sum(n) AS n, sum(t) AS t FROM counts
), shares AS (
  SELECT b, (s.t + {PRIOR} * s.n / o.n) / (o.t + {PRIOR}) AS target,
    (s.n + {PRIOR} * s.n / o.n) / (o.n + {PRIOR}) AS background
  FROM singles s CROSS JOIN totals o
), losses AS (
  SELECT c.a, c.b,
    -log2(CASE WHEN f.t > 0 THEN {LAMBDA}::DOUBLE * c.t / f.t + (1 - {LAMBDA}::DOUBLE) * s.target
      ELSE s.target END) AS target,
    -log2({LAMBDA}::DOUBLE * c.n / f.n + (1 - {LAMBDA}::DOUBLE) * s.background) AS background
  FROM counts c JOIN befores f ON c.a = f.a JOIN shares s ON c.b = s.b
), means AS (
  SELECT row_id, avg(target) AS target, avg(background) AS background
  FROM pairs p JOIN losses l ON p.a = l.a AND p.b = l.b GROUP BY row_id
)
SELECT doc_id, len(words) AS n_words, coalesce(round(target, 6), 0) AS target_loss,
  coalesce(round(background, 6), 0) AS background_loss,
  coalesce(round(target - background, 6), 0) AS score
FROM d LEFT JOIN means ON d.row_id = means.row_id
"""

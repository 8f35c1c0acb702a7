"""Merkle manifest of a table, with proofs from checkpoints.

Every row becomes a leaf, every language a binary tree over its leaves by doc_id, and the trees' roots
(subroots) form one more tree. Only every ``STRIDE``-th level is stored: the nodes of such a level are
kept in blocks of ``2 ** STRIDE`` that one node of the next stored level covers. A proof needs siblings
of the levels between as well. They are made again from each block's stored nodes while the paths
are handed down from the root, block by block, and dropped with the block. Every block has a bounded
number of nodes, so a tree of any size, or a table that is nearly all one language, is spread evenly.
"""

from __future__ import annotations

import hashlib

from collections.abc import Iterator

import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import kept, numbered

#: Levels from one stored level to the next; a block has two to this power of nodes.
STRIDE = 5
#: Blocks whose paths are held in Python at a time.
TOGETHER = 128
#: A leaf is tampered with where this divides the crc32 of its doc_id.
TAMPERED = 7


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------------- leaves


def _written(value: Column) -> Column:
    """A value after its length in bytes and a colon; null is ``-``."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaves(docs: DataFrame) -> DataFrame:
    """``branch``, doc_id, ``leaf`` and ``changed``, the leaf after tampering, null where it has none.

    ``branch`` is the language behind a plus sign, empty for null, so it sorts as languages should.
    """

    def leaf(n_chars: Column) -> Column:
        first = (_written(F.col(c)) for c in ("doc_id", "source", "lang"))
        return F.sha2(F.concat(*first, _written(n_chars), _written(F.col("text"))), 256)

    lang, n_chars = F.col("lang").cast("string"), F.col("n_chars")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    return docs.select(
        F.when(lang.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), lang)).alias("branch"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf(n_chars).alias("leaf"),
        F.when(chosen, leaf(n_chars.cast("decimal(20,0)") + 1)).alias("changed"),
    )


# --------------------------------------------------------------- stored levels


def _levels_left(total: int, stored: int) -> int:
    """Levels that a block of the ``stored``-th stored level has to fold, of ``total`` leaves in all."""
    return max(0, min(STRIDE, (total - 1).bit_length() - stored * STRIDE))


def folded(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes, and those of each level above them."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return out


def blocks(nodes: DataFrame, name: str) -> DataFrame:
    """Nodes (tree, total, rank, digest, doc_id, changed) in stored blocks, each in order of rank."""
    return kept(
        nodes.groupBy("tree", "total", F.shiftright("rank", STRIDE).alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("rank", "digest", "doc_id", "changed"))).alias("nodes")
        ),
        name,
    )


NODES = "tree long, total long, rank long, digest string"


def covering(stored: DataFrame, level: int) -> DataFrame:
    """The one node above each block of the ``level``-th stored level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                tree, total, block, nodes = (part.column(i) for i in range(4))
                pairs = zip(nodes.to_pylist(), total.to_pylist())
                made = [folded(found, _levels_left(n, level))[-1][0] for found, n in pairs]
                yield pa.RecordBatch.from_arrays(
                    [tree, total, block, pa.array(made, pa.string())], names=["tree", "total", "rank", "digest"]
                )

    return stored.select("tree", "total", "block", "nodes.digest").mapInArrow(run, NODES)


def stored_levels(nodes: DataFrame, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of every stored level from the leaves up, and the root of each tree.

    ``most`` is the number of leaves of the largest tree.
    """
    levels = []
    while True:
        levels.append(blocks(nodes, f"{name}-{len(levels)}"))
        nodes = covering(levels[-1], len(levels) - 1)
        if most <= 1 << STRIDE * len(levels):
            return levels, kept(nodes, f"{name}-roots")
        nodes = nodes.withColumns({"doc_id": F.lit(None).cast("long"), "changed": F.lit(None).cast("string")})


# ---------------------------------------------------------------------- proofs

PATHS = "tree long, rank long, subroot string, root string, above array<string>"


def _siblings(nodes: list[str], levels: int) -> Iterator[list[str]]:
    """For each node its sibling in each level of the block: ``L`` or ``R`` for its side, then its
    digest; empty where the node has none."""
    rows = folded(nodes, levels)
    for i in range(len(nodes)):
        path = []
        for level in range(levels):
            at, row = (i >> level) ^ 1, rows[level]
            path.append(("R" if at & 1 else "L") + row[at] if at < len(row) else "")
        yield path


def climbed(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its siblings lead to."""
    for sibling in path:
        side, other = sibling[:1], sibling[1:]
        leaf = digest(other + leaf if side == "L" else leaf + other)
    return leaf


def proof(path: list[str]) -> str:
    return digest("".join(sibling[1:] for sibling in path))


def _joined(stored: DataFrame, above: DataFrame) -> DataFrame:
    """Each block beside the path of the node that covers it."""
    return stored.join(above.withColumnRenamed("rank", "block"), ["tree", "block"]).select(
        "tree", "total", "block", "nodes", "subroot", "root", "above"
    )


def _per_block(batch: pa.RecordBatch, level: int) -> Iterator[tuple[dict, list, list[list[str]]]]:
    """Each block, its nodes, and the whole path of each node."""
    for at in range(0, batch.num_rows, TOGETHER):
        for block in batch.slice(at, TOGETHER).to_pylist():
            found = [node["digest"] for node in block["nodes"]]
            paths = _siblings(found, _levels_left(block["total"], level))
            yield block, block["nodes"], [own + block["above"] for own in paths]


def _batches(rows: Iterator[tuple], schema: str, size: int) -> Iterator[pa.RecordBatch]:
    kinds = {
        "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())
    }
    names, types = zip(*(field.split() for field in schema.split(", ")))
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        columns = zip(*held) if held else [()] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kinds[t]) for c, t in zip(columns, types)], names=list(names)
        )

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield made()
            held = []
    yield made()


def handed_down(stored: DataFrame, level: int, above: DataFrame) -> DataFrame:
    """Paths of the nodes of a stored level from those of the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (block["tree"], node["rank"], block["subroot"], block["root"], path)
            for batch in batches
            for block, nodes, paths in _per_block(batch, level)
            for node, path in zip(nodes, paths)
        )
        yield from _batches(rows, PATHS, 2048)

    return _joined(stored, above).mapInArrow(run, PATHS)


SCHEMA = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def proven(stored: DataFrame, above: DataFrame) -> DataFrame:
    """Each leaf with the digest of its proof and the root that it leads to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for block, nodes, paths in _per_block(batch, 0):
                    for node, path in zip(nodes, paths):
                        reached = climbed(node["changed"] or node["digest"], path)
                        yield (
                            node["doc_id"], node["digest"], block["subroot"], block["root"],
                            proof(path), reached, reached == block["root"],
                        )

        yield from _batches(rows(), SCHEMA, 4096)

    return _joined(stored, above).mapInArrow(run, SCHEMA)


def manifest(docs: DataFrame) -> DataFrame:
    """The manifest of documents (doc_id, source, lang, n_chars, text) and a check of each leaf.

    A null value is written ``-``, an empty text ``0:``; texts are hashed whole at any length. Leaves of a
    language ascend by doc_id, without one first, then by digest; rows that are equal throughout
    are leaves of their own, one beside the other. A null doc_id is never tampered with, and a null
    n_chars stays null, so such a leaf still verifies. No rows give no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    by_doc = numbered(kept(leaves(docs), "leaves"), "row", "branch", "doc_id", "leaf")
    branches = by_doc.groupBy("branch").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("total"))
    trees = kept(numbered(kept(branches, "branches"), "tree", "branch"), "trees")
    sizes = trees.agg(F.max("total"), F.count(F.lit(1))).first()
    if not sizes[1]:
        return spark.createDataFrame([], SCHEMA)
    nodes = by_doc.join(trees, "branch").select(
        "tree", "total", (F.col("row") - F.col("first")).alias("rank"), F.col("leaf").alias("digest"), "doc_id", "changed"
    )
    levels, subroots = stored_levels(nodes, sizes[0], "documents")
    none = {"doc_id": F.lit(None).cast("long"), "changed": F.lit(None).cast("string")}
    over = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(sizes[1]).cast("long").alias("total"), F.col("tree").alias("rank"), "digest"
    ).withColumns(none)
    top, root = stored_levels(over, sizes[1], "subroots")
    no_path = F.array().cast("array<string>")
    above = root.select("tree", "rank", F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"), no_path.alias("above"))
    for level in range(len(top) - 1, -1, -1):
        above = handed_down(top[level], level, above)
    begin = above.select(F.col("rank").alias("tree"), "root", "above")
    above = subroots.join(begin, "tree").select("tree", "rank", F.col("digest").alias("subroot"), "root", "above")
    for level in range(len(levels) - 1, 0, -1):
        above = handed_down(levels[level], level, above)
    return proven(levels[0], above)


#: The same in DuckDB: trees by recursion over levels, crc32 by its polynomial (fixed value).
ORACLE = """
WITH RECURSIVE rows AS (
    SELECT doc_id, source, lang, n_chars, text, CAST(doc_id AS VARCHAR) AS id,
           list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)),
               lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)),
                   lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
    FROM documents
), leaves AS (
    SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos,
           count(*) OVER (PARTITION BY lang) AS n, leaf, CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN changed ELSE leaf END AS given
    FROM (
        SELECT *, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
               sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) AS changed
        FROM (
            SELECT *, coalesce(strlen(id) || ':' || id, '-') || coalesce(strlen(source) || ':' || source, '-')
                      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                   coalesce(strlen(text) || ':' || text, '-') AS tail
            FROM rows
        )
    )
), below AS (
    SELECT lang, 0::BIGINT AS level, pos, leaf AS node, n FROM leaves
    UNION ALL
    SELECT lang, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2
    FROM below WHERE n > 1 GROUP BY lang, level, pos // 2, n
), subroots AS (
    SELECT lang, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM below WHERE n = 1
), top AS (
    SELECT 0::BIGINT AS level, pos, node, n FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2
    FROM top WHERE n > 1 GROUP BY level, pos // 2, n
), steps AS (
    SELECT l.doc_id, l.lang, l.pos AS leaf_pos, own.level, own.pos & 1 AS side, other.node AS sibling
    FROM leaves l JOIN below own ON own.lang IS NOT DISTINCT FROM l.lang AND own.n > 1 AND own.pos = l.pos >> own.level::INT
    LEFT JOIN below other ON other.lang IS NOT DISTINCT FROM l.lang AND other.level = own.level AND other.pos = xor(own.pos, 1)
    UNION ALL
    SELECT l.doc_id, l.lang, l.pos, 100 + own.level, own.pos & 1, other.node
    FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
    JOIN top own ON own.n > 1 AND own.pos = s.pos >> own.level::INT
    LEFT JOIN top other ON other.level = own.level AND other.pos = xor(own.pos, 1)
), paths AS (
    SELECT lang, leaf_pos, list({'side': side, 'sibling': coalesce(sibling, '')} ORDER BY level) AS path,
           string_agg(coalesce(sibling, ''), '' ORDER BY level) AS siblings
    FROM steps GROUP BY lang, leaf_pos
), proofs AS (
    SELECT l.*, coalesce(p.path, []) AS path, sha256(coalesce(p.siblings, '')) AS proof
    FROM leaves l LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM l.lang AND p.leaf_pos = l.pos
), climb AS (
    SELECT lang, pos, 0 AS step, given AS node, path FROM proofs
    UNION ALL
    SELECT lang, pos, step + 1, sha256(CASE WHEN path[step + 1].side = 1 THEN path[step + 1].sibling || node ELSE node || path[step + 1].sibling END), path
    FROM climb WHERE step < len(path)
)
SELECT p.doc_id, p.leaf, s.node AS subroot, t.node AS root, p.proof AS proof_sha256, c.node AS folded_root, c.node = t.node AS verified
FROM proofs p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
JOIN climb c ON c.lang IS NOT DISTINCT FROM p.lang AND c.pos = p.pos AND c.step = len(p.path)
CROSS JOIN (SELECT node FROM top WHERE n = 1) t
"""

"""Fuzzy line deduplication by MinHash over character shingles.

Signatures of a line's shingles are cut into bands; lines that share a band are candidates. With
nine bands of three hashes a pair at the threshold is found with probability 0.998. Candidates are
verified by the exact Jaccard similarity of their shingle sets, and a distributed union-find makes
components of the links, of which the first line stays.

A band that many lines share is not spelt out as pairs. First each line is held against the band's
first line only. After a union-find, the bands whose lines still lie in different components are gone
through in the tasks that hold them: two lines are compared only if they lie in different components
and bitmaps of their shingles do not rule a link out, and only links that join components leave the
task. So no link that the bands find is lost, and a group costs rows in proportion to its size.
"""

from __future__ import annotations

import hashlib
import zlib

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmetrics.llm.common import kept, own_columns, unused, with_length
from tripmetrics.llm.components import components

#: Characters of a shingle, as many as a 64-bit number has bytes; a shorter line is one shingle.
SHINGLE = 8
SIMILAR = 0.8
BANDS, ROWS = 9, 3
#: Lines of a band that one task compares; larger bands are cut into pairs of blocks.
BLOCK = 4096
#: 64-bit words of a shingle bitmap.
BITMAP = 32
#: Characters that are hashed at a time.
CHUNK = 1 << 16
#: Order of rows without an id: after all others.
NO_ID = (1 << 63) - 1

#: A character of a word.
WORD = r"[^\x20\x09-\x0D]"
_BLANKS = " \t\n\v\f\r"
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Odd factors; multiplying by one permutes the 32-bit numbers.
_FACTORS = (_mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def _hashed(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash of each run of SHINGLE characters of the joined lines, and where the lines' own
    shingles begin and end among them."""
    padded = [line.ljust(SHINGLE, "\0") for line in lines]
    codes = np.frombuffer("".join(padded).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    width, h = 1, codes
    while width < SHINGLE:  # a power of two; each step joins neighbours of half the width
        h = h[:-width] * np.uint64(pow(int(_MUL), width, 1 << 64)) + h[width:]
        width *= 2
    h = np.append(h, np.uint64(0))  # one more, so that the last line has an end
    lengths = np.array([len(line) for line in padded])
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    return _mixed(h), starts, starts + lengths - SHINGLE + 1


def bands(lines: list[str]) -> np.ndarray:
    """A row of band keys for each line. Any two equal lines have equal rows.

    Permutations are of 32 bits, half the work of 64; hashes that meet only make candidates, which are verified.
    """
    h, starts, ends = _hashed(lines)
    h = (h >> np.uint64(32)).astype(np.uint32)
    edges = np.stack([starts, ends], axis=1).ravel()
    permuted = np.empty_like(h)
    keys = np.zeros((len(lines), BANDS), dtype=np.uint64)
    for k, factor in enumerate(_FACTORS):
        least = np.minimum.reduceat(np.multiply(h, factor, out=permuted), edges)[::2]
        keys[:, k // ROWS] = _mixed(keys[:, k // ROWS] * _MUL + least)
    return (keys ^ _mixed(np.arange(BANDS, dtype=np.uint64) + _MUL)).view(np.int64)


def _chunks(lines: list[str]) -> Iterator[list[str]]:
    """The lines in parts of about CHUNK characters."""
    part, size = [], 0
    for line in lines:
        part.append(line)
        size += len(line)
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def banded(docs: DataFrame) -> DataFrame:
    """``band`` and ``line_id`` of the lines with a word, each line once for a batch of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = {line for text in batch.column(0) for line in (text.as_py() or "").split("\n") if line.strip(_BLANKS)}
            for part in _chunks(list(lines)):
                ids = [hashlib.md5(line.encode(), usedforsecurity=False).digest() for line in part]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bands(part).ravel()),
                        pa.array([line_id for line_id in ids for _ in range(BANDS)], pa.binary()),
                    ],
                    names=["band", "line_id"],
                )

    return docs.select("text").mapInArrow(run, "band long, line_id binary")


def _lines(docs: DataFrame, *columns: str) -> DataFrame:
    return (
        docs.select(*columns, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
        .filter(F.col("line").rlike(WORD))
        .withColumn("line_id", F.unhex(F.md5("line")))
    )


def shingles(line: str) -> set[str]:
    return {line[i : i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


def spelt(line: str) -> np.ndarray | set[str]:
    """The different shingles of a line, to be counted and compared by ``shared``.

    A shingle of Latin-1 characters is eight bytes, hence one 64-bit number that no other shingle
    has; such lines become sorted numbers. Others, and those shorter than a shingle, stay strings.
    """
    try:
        held = line.encode("latin-1")
    except UnicodeEncodeError:
        return shingles(line)
    if len(held) < SHINGLE:
        return shingles(line)
    found = np.sort(np.ndarray(len(held) - SHINGLE + 1, dtype="<u8", buffer=held, strides=(1,)))
    new = np.empty(len(found), dtype=bool)
    new[0] = True
    np.not_equal(found[1:], found[:-1], out=new[1:])
    return found[new]


def _number(shingle: str) -> int:
    """The number of ``spelt`` where it has one, so that lines of both kinds agree; else a checksum."""
    try:
        held = shingle.encode("latin-1")
    except UnicodeEncodeError:
        return zlib.crc32(shingle.encode("utf-8", "surrogatepass"))
    return int.from_bytes(held, "little")


def _strings(found: np.ndarray | set[str]) -> set[str]:
    if isinstance(found, set):
        return found
    return {shingle.tobytes().decode("latin-1") for shingle in found}


def shared(one: np.ndarray | set[str], two: np.ndarray | set[str]) -> int:
    """How many shingles two lines have in common."""
    if isinstance(one, set) or isinstance(two, set):
        return len(_strings(one) & _strings(two))
    both = np.concatenate([one, two])
    both.sort(kind="stable")  # merges the two sorted runs
    return int(np.count_nonzero(both[1:] == both[:-1]))


def similar_spelt(one: np.ndarray | set[str], two: np.ndarray | set[str]) -> bool:
    """Whether the Jaccard similarity of two lines' shingles reaches the threshold, exactly."""
    fewer, more = sorted((len(one), len(two)))
    if fewer < SIMILAR * more:
        return False  # they cannot share more than the smaller has
    common = shared(one, two)
    return common >= SIMILAR * (fewer + more - common)


def similar(a: str, b: str) -> bool:
    """Whether the Jaccard similarity of two lines' shingle sets reaches the threshold."""
    return similar_spelt(spelt(a), spelt(b))


def candidate_lines(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """``line_id`` and ``line`` of the lines that share a band with another line."""
    wanted = shared.select("line_id").distinct()
    lines = _lines(docs).select("line_id", "line")
    return kept(lines.join(wanted, "line_id", "left_semi").dropDuplicates(["line_id"]), "lines")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of line ids whose lines are similar."""
    first = texts.select(F.col("line_id").alias("a"), F.col("line").alias("line_a"))
    second = texts.select(F.col("line_id").alias("b"), F.col("line").alias("line_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("line_a").to_pylist(), batch.column("line_b").to_pylist()
            near = pa.array([similar(x, y) for x, y in zip(a, b)], pa.bool_())
            yield batch.select(["a", "b"]).filter(near)

    return pairs.join(first, "a").join(second, "b").mapInArrow(run, "a binary, b binary")


def bitmaps(found: list[np.ndarray | set[str]]) -> np.ndarray:
    """A row of bits for each line's shingles, one for each, several to a bit where their hashes meet."""
    width = 64 * BITMAP
    bits = np.zeros((len(found), width), dtype=np.uint8)
    for row, own in zip(bits, found):
        if isinstance(own, set):
            own = np.array([_number(shingle) for shingle in own], dtype=np.uint64)
        row[(own * _MUL >> np.uint64(64 - width.bit_length() + 1)).astype(np.intp)] = 1
    return np.packbits(bits, axis=1).view(np.uint64)


def spanning_links(lines: list[str], roots: list[bytes]) -> list[tuple[int, int]]:
    """Similar pairs (by place) that join the components ``roots`` of the lines, no more than join them.

    Each bit that one line has and another lacks is at least one shingle that only the first has,
    so the bits bound the shared shingles from above; a pair that the bound rules out isn't compared.
    """
    found = [spelt(line) for line in lines]
    sizes = np.array([len(own) for own in found])
    bits = bitmaps(found)
    numbers = {root: k for k, root in enumerate(dict.fromkeys(roots))}
    root = np.array([numbers[r] for r in roots])
    links = []
    for i in range(len(lines) - 1):
        later = np.flatnonzero(root[i + 1 :] != root[i]) + i + 1
        if not len(later):
            continue
        own = sizes[i] - np.bitwise_count(bits[i] & ~bits[later]).sum(axis=1, dtype=np.int64)
        other = sizes[later] - np.bitwise_count(bits[later] & ~bits[i]).sum(axis=1, dtype=np.int64)
        most = np.minimum(own, other)
        for j in later[most >= SIMILAR * (sizes[i] + sizes[later] - most)].tolist():
            if root[i] != root[j] and similar_spelt(found[i], found[j]):
                links.append((i, j))
                root[root == root[j]] = root[i]
    return links


def crowded_links(crowded: DataFrame) -> DataFrame:
    """Links a, b between components of one band, from (band, line_id, root, line)."""
    sized = crowded.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    sized = sized.select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("line_id"), F.col("blocks")).cast("int")
    tasks = (
        crowded.join(sized, "band")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("band", F.least("own", "other"), F.greatest("own", "other")).alias("task"),
            "line_id",
            "root",
            "line",
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list[tuple]) -> pa.RecordBatch:
            links = spanning_links([row[3] for row in found], [row[2] for row in found]) if len(found) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([found[pair[k]][1] for pair in links], pa.binary()) for k in (0, 1)], names=["a", "b"]
            )

        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if held and held[0][0] != row[0]:
                    yield out(held)
                    held = []
                held.append(row)
        if held:
            yield out(held)

    # A number of its own: few bytes take long here, so partitions merged by size would be too few.
    parts = int(crowded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tasks.repartition(parts, "task").sortWithinPartitions("task")
    return dealt.mapInArrow(run, "a binary, b binary").distinct()


def line_components(docs: DataFrame) -> DataFrame:
    """``node`` and ``root`` of each line (by id) that is similar to a different line."""
    in_band = Window.partitionBy("band")
    # A line comes once for each batch it is in, so a band is shared if its ids differ.
    shared = kept(
        banded(docs)
        .repartition("band")
        .select("band", "line_id", *(f("line_id").over(in_band).alias(n) for n, f in (("first", F.min), ("last", F.max))))
        .filter("first != last")
        .distinct()
        .select("band", "line_id", "first", F.count("line_id").over(in_band).alias("n")),
        "bands",
    )
    stars = shared.filter("first != line_id").select(F.col("first").alias("a"), F.col("line_id").alias("b"))
    texts = candidate_lines(docs, shared)  # both rounds look at these lines only
    found = kept(components(verified(stars.distinct(), texts)), "components")
    # In a band of two lines the first round has said all; in a larger one, what is left apart.
    placed = (
        shared.filter("n > 2")
        .join(found, shared["line_id"] == found["node"], "left")
        .select("band", "line_id", F.coalesce("root", "line_id").alias("root"))
    )
    apart = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    crowded = kept(
        placed.join(apart.filter("low != high").select("band"), "band").join(texts, "line_id"), "crowded"
    )
    more = crowded_links(crowded)
    return components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))


def row_key() -> Column:
    """Digest of doc_id and text: rows of one doc_id, or of none, with different texts differ."""
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.unhex(F.md5(F.concat_ws("|", number, F.coalesce("text", F.lit("")))))


def _decisions(docs: DataFrame) -> DataFrame:
    """``line_decisions`` with the ``row`` (by its key) that each line is in."""
    docs = docs.select("doc_id", "text")
    found = kept(line_components(docs), "components")
    here = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), "row", "line_no")
    lines = _lines(docs.withColumn("row", row_key()), "doc_id", "row").select(
        "doc_id", "row", "line_no", "line_id", here.alias("here")
    )
    rooted = kept(
        lines.join(found, lines["line_id"] == found["node"], "left").select(
            "doc_id", "row", "line_no", "here", F.coalesce("root", "line_id").alias("root")
        ),
        "rooted",
    )
    first = kept(rooted.groupBy("root").agg(F.min("here").alias("first")), "first")
    return rooted.join(first, "root").select(
        "doc_id",
        "row",
        "line_no",
        (F.col("here") == F.col("first")).alias("kept"),
        F.nullif(F.col("first.key"), F.lit(NO_ID)).alias("first_doc_id"),
        F.col("first.line_no").alias("first_line_no"),
    )


def line_decisions(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, kept, first_doc_id and first_line_no of every line with a word.

    ``docs`` has doc_id and text; other columns are not looked at. Lines are cut at \\n; equal and
    similar lines form components, of which the line with the smallest (doc_id, line_no) is kept,
    documents without an id last. Blank lines, null and empty texts have no rows. Rows of one doc_id,
    or without one, are documents of their own, in the order of their digests, where their texts
    differ; equal rows count as one document.
    """
    return _decisions(docs).drop("row")


def _left(text: str, dropped: str) -> Column:
    lines = F.split(text, "\n")
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(dropped))
    return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")


def _one_each(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with one row for each ``key`` whose text has words; only repeated rows are shuffled."""
    again = kept(
        docs.filter(F.col("text").rlike(WORD)).groupBy(key).count().filter("count > 1").select(key), "again"
    )
    repeated = docs.join(again, key, "left_semi").dropDuplicates([key])
    return docs.join(again, key, "left_anti").select(*own_columns(docs)).union(repeated.select(*own_columns(docs)))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with each text less the lines that repeat an earlier one; all columns stay.

    Blank lines stay. A document that had words and keeps none of them goes; a document that had
    none stays as it is. Rows of one doc_id, or without one, are decided each by its own text; of
    equal rows (doc_id and text) with words any one stays. n_chars, where it is a column, follows
    the text.
    """
    key, row, gone = (unused(docs, name) for name in ("_row_key", "_row", "_gone"))
    dropped = (
        _decisions(docs)
        .filter("not kept")
        .groupBy(F.col("row").alias(row))
        .agg(F.collect_set("line_no").alias(gone))
    )
    changed = F.col(gone).isNotNull()
    named = _one_each(docs.withColumn(key, row_key()), key)
    out = named.join(dropped, named[key] == dropped[row], "left").withColumn(
        "text", F.when(changed, _left("text", gone)).otherwise(F.col("text"))
    )
    out = out.filter(~changed | F.col("text").rlike(WORD))
    return with_length(out, changed).select(*own_columns(docs))

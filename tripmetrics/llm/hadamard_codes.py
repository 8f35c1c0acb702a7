"""Vector codes by product quantisation, with an exact search over integers.

Vectors become integers and are cut into parts; each part position has a codebook. Parts and entries
are padded with zeros to a power of two and go through the Walsh-Hadamard transform, which is sums and
differences only. It scales every squared distance by the padded width and nothing else, so distances
can be added up coefficient by coefficient, the ones of low sequency (few changes of sign, where
most of a vector's energy lies) first. An entry leaves the search once its sum is past the best
distance known; no entry that could still win, or tie, ever does. There is no floating point after
the first rounding: numbers are 64-bit integers, or Python's own where those could overflow.
"""

from __future__ import annotations

import hashlib
import math

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import kept

#: Parts of a vector, entries of a codebook, rounds of improvement, and the scale of components.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Bits of the digits that sums are added up in.
DIGIT = 32
#: Numbers that the search holds at a time.
TOGETHER = 1 << 18
_LONG = 1 << 63


# ------------------------------------------------------------------ transform


def transformed(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row, padded to a power of two, by rising sequency."""
    n, width = rows.shape
    padded = 1 << max(0, (width - 1).bit_length())
    out = np.zeros((n, padded), dtype=rows.dtype)
    out[:, :width] = rows
    half = 1
    while half < padded:
        pairs = out.reshape(n, -1, 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, padded)
        half *= 2
    return out[:, sequency(padded)]


def sequency(width: int) -> np.ndarray:
    """The natural order's coefficients by the number of sign changes of their functions."""
    at = np.arange(width)
    signs = np.array([[bin(i & j).count("1") & 1 for j in range(width)] for i in range(width)])
    return at[np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")]


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest entry, the lower of equals, and their squared distance."""
    n, width = rows.shape
    if not width:
        return np.zeros(n, np.int64), np.zeros(n, rows.dtype)
    a, b = transformed(rows), transformed(entries)
    padded = a.shape[1]
    # The entry nearest in the first coefficient gives a bound that few others get under.
    sums = (a[:, :1] - b[:, 0]) ** 2
    guess = sums.argmin(axis=1)
    bound = ((a - b[guess]) ** 2).sum(axis=1)
    row, entry = np.nonzero(sums <= bound[:, None])
    sums = sums[row, entry]
    for k in range(1, padded):
        sums = sums + (a[row, k] - b[entry, k]) ** 2
        stays = sums <= bound[row]
        row, entry, sums = row[stays], entry[stays], sums[stays]
    # Left are whole distances, each row's guess or better among them, by row and then entry.
    if sums.dtype == object:
        order = np.array(sorted(range(len(row)), key=lambda i: (row[i], sums[i], entry[i])), dtype=np.int64)
    else:
        order = np.lexsort((entry, sums, row))
    first = order[np.unique(row[order], return_index=True)[1]]
    return entry[first], sums[first] // padded


# -------------------------------------------------------------------- integers


def _whole(x: float) -> int:
    return SCALE * int(x) if abs(x) >= 1 << 53 else math.floor(SCALE * x)


def integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of finite doubles, as Python integers where 64 bits do not hold them."""
    if not values.size or np.abs(values).max() < 1 << 52:
        return np.floor(values * SCALE).astype(np.int64)
    flat = [_whole(x) for x in values.ravel().tolist()]
    return np.array(flat, dtype=object).reshape(values.shape)


def _searchable(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers if no sum of the search can overflow, else as Python integers."""
    if not rows.size or not entries.size:
        return rows, entries
    largest = max(abs(int(f(x))) for x in (rows, entries) for f in (np.min, np.max))
    padded = 1 << max(0, (rows.shape[1] - 1).bit_length())
    kind = np.int64 if (2 * padded * largest) ** 2 * padded < _LONG else object
    return rows.astype(kind), entries.astype(kind)


def searched(vectors: np.ndarray, books: list[np.ndarray]) -> Iterator[tuple[slice, list, list]]:
    """For slices of the vectors the codes and distances of every part."""
    width = vectors.shape[1] // PARTS
    step = max(1, TOGETHER // max(ENTRIES, width))
    for at in range(0, len(vectors), step):
        rows = slice(at, at + step)
        found = [
            nearest(*_searchable(vectors[rows, p * width : (p + 1) * width], books[p])) for p in range(PARTS)
        ]
        yield rows, [f[0] for f in found], [f[1] for f in found]


# ------------------------------------------------------------------ codebooks


def _vectors(batch: pa.RecordBatch, column: int, size: int) -> np.ndarray:
    flat = batch.column(column).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return integers(flat.reshape(batch.num_rows, size))


def _digits(value: int) -> Iterator[tuple[int, int]]:
    """A number of any size as digits that 64-bit sums can add up, the sign in the last."""
    k = 0
    while not -_LONG >> DIGIT <= value < _LONG >> DIGIT:
        yield k, value & ((1 << DIGIT) - 1)
        value >>= DIGIT
        k += 1
    yield k, value


def sums(vectors: DataFrame, books: list[np.ndarray], size: int) -> DataFrame:
    """What each task's parts add up to by entry: part, entry, place (-1: their number), digit, total."""
    width = size // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            found = _vectors(batch, 0, size)
            for rows, codes, _ in searched(found, books):
                for p in range(PARTS):
                    part = found[rows, p * width : (p + 1) * width]
                    order = np.argsort(codes[p], kind="stable")
                    used, begins, n = np.unique(codes[p][order], return_index=True, return_counts=True)
                    # Components below 2 ** 60 / TOGETHER cannot overflow here, others are Python's.
                    part = part if part.dtype == object or np.abs(part).max(initial=0) < 1 << 42 else part.astype(object)
                    added = np.add.reduceat(part[order], begins, axis=0) if width else np.zeros((len(used), 0))
                    for j, entry in enumerate(used.tolist()):
                        for place, value in enumerate([int(n[j]), *map(int, added[j])], start=-1):
                            key = (p, entry, place)
                            total[key] = total.get(key, 0) + value
        out = [(*key, k, digit) for key, value in total.items() for k, digit in _digits(value)]
        columns = zip(*out) if out else [()] * 5
        names = ("part", "entry", "place", "digit", "total")
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(names))

    per_task = vectors.select("vector").mapInArrow(
        run, "part long, entry long, place long, digit long, total long"
    )
    return per_task.groupBy("part", "entry", "place", "digit").agg(F.sum("total").alias("total"))


def improved(vectors: DataFrame, books: list[np.ndarray], size: int) -> list[np.ndarray]:
    """Every entry at the floor of the mean of its parts; entries without parts stay.

    The driver gets one row for each component of the codebooks and digit, a fixed number at any input size.
    """
    total: dict[tuple[int, int, int], int] = {}
    for part, entry, place, digit, value in sums(vectors, books, size).collect():
        key = (part, entry, place)
        total[key] = total.get(key, 0) + (value << DIGIT * digit)
    out = []
    for p, book in enumerate(books):
        rows = [
            [total[p, j, i] // total[p, j, -1] for i in range(len(entry))] if (p, j, -1) in total else entry
            for j, entry in enumerate(book.tolist())
        ]
        out.append(_held(rows))
    return out


def _held(rows: list[list[int]]) -> np.ndarray:
    """Rows of integers, in 64 bits if they fit."""
    fits = all(-_LONG <= x < _LONG for row in rows for x in row)
    return np.array(rows, dtype=np.int64 if fits else object).reshape(len(rows), -1)


def first_books(vectors: DataFrame, size: int) -> list[np.ndarray]:
    """The parts of the vectors with the smallest vec_ids, nulls last, equal ids by vector."""
    order = [F.asc_nulls_last("vec_id"), F.asc("vector")]
    found = vectors.orderBy(*order).limit(ENTRIES).collect()  # as many rows as a codebook has entries
    rows = [[_whole(float(x)) for x in r["vector"]] for r in found]
    width = size // PARTS
    return [_held([row[p * width : (p + 1) * width] for row in rows]) for p in range(PARTS)]


def books_digest(books: list[np.ndarray]) -> str:
    numbers = (str(x) for book in books for entry in book.tolist() for x in entry)
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


# ----------------------------------------------------------------------- codes


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and ``vector`` of the rows whose vector is there and finite throughout.

    Vectors have to be of one length that the number of parts divides: that of the smallest vec_id
    among those that it divides. Others cannot be coded beside them and are left out too.
    """
    found = vectors.select("vec_id", "label", F.col("embedding").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return found.filter(F.col("vector").isNotNull() & ~bad & (F.size("vector") % PARTS == 0))


SCHEMA = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def coded(vectors: DataFrame, books: list[np.ndarray], size: int) -> DataFrame:
    """vec_id, label, code and error of every vector. An error past 64 bits is null."""
    schema = f"vec_id long, label {vectors.schema['label'].dataType.simpleString()}, code string, error long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _vectors(batch, 2, size)
            codes: list[str] = []
            errors: list[int | None] = []
            for _, parts, distances in searched(found, books):
                codes += (bytes(row).hex() for row in np.stack(parts, axis=1).astype(np.uint8))
                added = np.stack([d.astype(object) for d in distances], axis=1).sum(axis=1)
                errors += (e if e < _LONG else None for e in added.tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    return vectors.select("vec_id", "label", "vector").mapInArrow(run, schema)


def compressed(vectors: DataFrame) -> DataFrame:
    """Codes and errors of a table of vectors (vec_id, embedding, label).

    Rows whose vector is null, or holds null, NaN or an infinity, are left out, and so are those of
    another length (``usable``). A null vec_id comes last in the choice of the first entries; repeated
    rows are coded each. With fewer vectors than entries the codebooks are that much shorter. A
    ``label_error`` past 64 bits is null. Empty vectors have code zero and no error. Other columns are not
    looked at, and no rows give no rows. Vectors of any length are read in batches of bounded size.
    """
    spark = vectors.sparkSession
    found = usable(vectors)
    first = found.orderBy(F.asc_nulls_last("vec_id"), F.asc("vector")).select(F.size("vector")).first()
    if first is None:
        return spark.createDataFrame([], SCHEMA)
    size = first[0]
    found = found.filter(F.size("vector") == size)
    books = first_books(found, size)
    for _ in range(ROUNDS):
        books = improved(found, books, size)
    rows = kept(coded(found, books, size), "codes")
    unknown = F.count_if(F.col("error").isNull()) > 0
    added = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long")
    by_label = rows.groupBy(F.col("label").alias("of")).agg(F.when(~unknown, added).alias("label_error"))
    return rows.join(by_label, rows["label"].eqNullSafe(by_label["of"])).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )


def oracle() -> str:
    """The same in DuckDB: a search over all entries."""
    parts = f"generate_series(0, {PARTS - 1})"
    assign = """
        SELECT vec_id, p, min_by(j, d * 64 + j) AS j, min(d) AS d, any_value(x) AS x
        FROM (SELECT v.vec_id, v.p, v.x, b.j, CAST(list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
              FROM parts v JOIN {books} b ON b.p = v.p)
        GROUP BY 1, 2
    """
    steps = []
    for k in range(ROUNDS):
        steps.append(f"near{k} AS ({assign.format(books=f'books{k}')})")
        steps.append(f"""means{k} AS (
            SELECT p, j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x
            FROM (SELECT p, j, i, sum(x[i])::BIGINT AS s, count(*) AS n
                  FROM (SELECT p, j, x, unnest(range(1, len(x) + 1)) AS i FROM near{k}) GROUP BY p, j, i)
            GROUP BY p, j
        ), books{k + 1} AS (
            SELECT b.p, b.j, coalesce(m.x, b.x) AS x FROM books{k} b LEFT JOIN means{k} m ON m.p = b.p AND m.j = b.j
        )""")
    joined = ",\n".join(steps)
    return f"""
    WITH whole AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), parts AS (
        SELECT vec_id, p, x[p * (len(x) // {PARTS}) + 1 : (p + 1) * (len(x) // {PARTS})] AS x
        FROM (SELECT vec_id, x, unnest({parts}) AS p FROM whole)
    ), books0 AS (
        SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS j, x FROM parts
        WHERE vec_id IN (SELECT vec_id FROM whole ORDER BY vec_id LIMIT {ENTRIES})
    ), {joined}, last AS ({assign.format(books=f'books{ROUNDS}')}),
    codes AS (
        SELECT vec_id, string_agg(printf('%02x', j), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM last GROUP BY vec_id
    )
    SELECT w.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY w.label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, j)) FROM books{ROUNDS}) AS codebooks_sha256
    FROM whole w JOIN codes c ON c.vec_id = w.vec_id
    """


ORACLE = oracle()

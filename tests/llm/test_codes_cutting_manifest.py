"""Vector codes, packing by column generation, the Merkle manifest."""

from __future__ import annotations

import hashlib
import math
import zlib

from collections import Counter, defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pytest

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripmetrics.llm import cutting_stock, hadamard_codes, merkle_manifest

from .conftest import EDGE_ROWS

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# ------------------------------------------------------------------ vector codes


def codes_by_hand(rows):
    """code, error and digest of the codebooks for (vec_id, vector) of whole numbers over 256."""
    size = len(rows[0][1]) // 16
    whole = {k: [math.floor(256 * x) for x in v] for k, v in rows}
    first = sorted(whole)[:64]
    books = [[whole[k][p * size : (p + 1) * size] for k in first] for p in range(16)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), j) for j, e in enumerate(book))

    for _ in range(2):
        for p, book in enumerate(books):
            members = defaultdict(list)
            for v in whole.values():
                part = v[p * size : (p + 1) * size]
                members[near(part, book)[1]].append(part)
            for j, parts in members.items():
                book[j] = [sum(c) // len(parts) for c in zip(*parts)]
    out = {}
    for k, v in whole.items():
        found = [near(v[p * size : (p + 1) * size], books[p]) for p in range(16)]
        out[k] = ("".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return out, digest


def vector_table(spark, rows):
    return spark.createDataFrame(
        [(k, v, label, "x", 1) for k, v, label in rows],
        "vec_id long, embedding array<double>, label int, code string, error int",
    )


@pytest.mark.parametrize("width", [1, 3, 4, 5])
def test_codes_of_any_width(spark, width):
    rng = np.random.default_rng(width)
    rows = [(k, rng.normal(0, 0.05, 16 * width).tolist(), [None, 1, 2][k % 3]) for k in range(150)]
    rows += [(200 + k, rows[k][1], 2) for k in range(5)]  # ties
    want, digest = codes_by_hand([(k, v) for k, v, _ in rows])
    found = hadamard_codes.compressed(vector_table(spark, rows)).collect()
    assert {r.vec_id: (r.code, r.error) for r in found} == want
    assert {r.codebooks_sha256 for r in found} == {digest}
    labels = {k: label for k, _, label in rows}
    by_label = Counter()
    for k, (_, error) in want.items():
        by_label[labels[k]] += error
    assert all(r.label_error == by_label[labels[r.vec_id]] for r in found)


def test_codes_of_numbers_past_64_bits(spark):
    rows = [(k, [(-1) ** k * 1e30 * (k % 7 + 1)] + [0.001 * k * j for j in range(15)], 1) for k in range(90)]
    want, digest = codes_by_hand([(k, v) for k, v, _ in rows])
    found = hadamard_codes.compressed(vector_table(spark, rows)).collect()
    assert {r.vec_id: r.code for r in found} == {k: code for k, (code, _) in want.items()}
    assert {r.codebooks_sha256 for r in found} == {digest}
    assert all(r.error == (e if (e := want[r.vec_id][1]) < 1 << 63 else None) for r in found)
    assert {r.label_error for r in found} in ({None}, {sum(e for _, e in want.values())})


def test_vectors_left_out(spark):
    good = [0.5] * 16
    bad = [None, [*good[1:], None], [*good[1:], float("nan")], [*good[1:], float("-inf")], [1.0] * 15, [1.0] * 32]
    rows = [(5, good, None), (None, [0.25] * 16, None), (5, good, 3), *((6 + k, v, 3) for k, v in enumerate(bad))]
    found = hadamard_codes.compressed(vector_table(spark, rows)).collect()
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in found) == Counter(
        [(5, "00" * 16, 0, 0), (5, "00" * 16, 0, 0), (None, "02" * 16, 0, 0)]
    )
    empty = hadamard_codes.compressed(vector_table(spark, [(1, [], None), (2, [], 1)])).collect()
    assert {(r.vec_id, r.code, r.error) for r in empty} == {(1, "00" * 16, 0), (2, "00" * 16, 0)}
    nothing = hadamard_codes.compressed(vector_table(spark, rows[3:]).filter("vec_id = 6"))
    assert nothing.collect() == [] and "codebooks_sha256" in nothing.columns


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 9), st.data())
def test_the_search_is_exact(width, data):
    number = st.integers(-3, 3) | st.integers(-(1 << 70), 1 << 70)
    rows = data.draw(st.lists(st.lists(number, min_size=width, max_size=width), min_size=1, max_size=6))
    entries = data.draw(st.lists(st.lists(number, min_size=width, max_size=width), min_size=1, max_size=6))
    held = hadamard_codes._searchable(hadamard_codes._held(rows), hadamard_codes._held(entries))
    index, distance = hadamard_codes.nearest(*held)
    want = [min((sum((a - b) ** 2 for a, b in zip(r, e)), j) for j, e in enumerate(entries)) for r in rows]
    assert [(int(d), int(j)) for d, j in zip(distance, index)] == want


@pytest.mark.parametrize("width", [1, 2, 4, 8, 16])
def test_transform_is_orthogonal_and_by_sequency(width):
    rows = hadamard_codes.transformed(np.eye(width, dtype=np.int64)).T  # one function a row
    assert (rows @ rows.T == width * np.eye(width)).all()
    assert [(np.diff(r) != 0).sum() for r in rows] == list(range(width))


@pytest.mark.parametrize("value", [0, -1, 5, -(1 << 40), (1 << 62) + 3, -(1 << 130) - 7])
def test_digits_add_up(value):
    assert sum(d << hadamard_codes.DIGIT * k for k, d in hadamard_codes._digits(value)) == value


# ------------------------------------------------------------------ cutting stock


def pieces_are_right(found, texts, capacity=1024):
    """Pieces of each text cover its ids once; sequences are gapless. Gives the padding."""
    library = Tokenizer.from_file(VOCABULARY)
    ids = {k: library.encode(t or "", add_special_tokens=False).ids + [0] for k, t in texts.items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert (len(part), zlib.crc32(part.tobytes()), len(ids[r.doc_id])) == (r.length, r.ids_crc32, r.doc_tokens)
    assert by_doc.keys() == ids.keys()
    for places, end in [(p, len(ids[k])) for k, p in by_doc.items()] + [(p, None) for p in by_sequence.values()]:
        at = 0
        for start, length in sorted(places):
            assert start == at and length > 0
            at += length
        assert at == end if end is not None else at <= capacity
    filled = [sum(n for _, n in places) for places in by_sequence.values()]
    return sum(cutting_stock.padded(n, capacity) - n for n in filled)


def test_packing_of_all_documents(documents, texts):
    found = cutting_stock.pack_documents(documents, RANKS, VOCABULARY).collect()
    padding = pieces_are_right(found, texts)
    assert padding < 0.005 * sum(r.length for r in found)
    whole = Counter(r.doc_id for r in found if r.doc_tokens < 1024)
    assert sum(n == 1 for n in whole.values()) > 0.5 * len(whole)


def test_packing_edges(spark, edge, nothing):
    found = cutting_stock.pack_documents(edge, RANKS, VOCABULARY).collect()
    library = Tokenizer.from_file(VOCABULARY)
    want = Counter()
    for doc, text, _ in EDGE_ROWS:
        want[doc] += len(library.encode(text or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for r in found:
        got[r.doc_id] += r.length
    assert got == want
    assert cutting_stock.pack_documents(nothing, RANKS, VOCABULARY).collect() == []
    special = {1: "a <|endoftext|> b", 2: "<|endoftext|>", 3: "", 4: None}
    df = spark.createDataFrame(list(special.items()), "doc_id long, text string")
    pieces_are_right(cutting_stock.pack_documents(df, RANKS, VOCABULARY).collect(), special)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=17, max_size=17))
def test_plan_places_every_rest_once(counts):
    counts = np.array([0, *counts[1:]])
    plan = cutting_stock.plan(counts)
    lengths = np.repeat(np.arange(17), counts)
    sequences = defaultdict(list)
    for number, length in enumerate(lengths.tolist()):
        i = np.searchsorted(plan.begin, number, side="right") - 1
        step, times = number - plan.begin[i], plan.times[i]
        if times:
            sequences[int(plan.sequence[i] + step // times)].append((int(plan.offset[i] + step % times * length), length))
        else:
            for size, (sequence, offset) in zip(cutting_stock.powers(length), plan.cuts[number], strict=True):
                sequences[sequence].append((offset, size))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 16
    assert sum(n for places in sequences.values() for _, n in places) == lengths.sum()


def all_patterns(lengths, capacity):
    for times in product(*(range(capacity // n + 1) for n in lengths)):
        if 0 < (s := sum(k * n for k, n in zip(times, lengths))) <= capacity:
            yield np.array(times), cutting_stock.padded(s, capacity) + cutting_stock.PIECE_COST


@pytest.mark.parametrize("seed", range(8))
def test_linear_program_is_optimal(seed, monkeypatch):
    """No pattern at all is worth more than it costs at the final prices: the proof of the least cost."""
    monkeypatch.setattr(cutting_stock, "PATIENCE", 10_000)
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(np.arange(2, 16), 5, replace=False))
    counts = rng.integers(50, 1000, 5)
    solved = cutting_stock.linear_program(lengths, counts, 16, gap=1e-9)
    matrix = np.zeros((5, 5))
    for k, (column, _) in enumerate(solved):
        matrix[column.rows, k] = column.times
    used = np.linalg.solve(matrix, counts)
    prices = np.linalg.solve(matrix.T, [column.cost for column, _ in solved])
    assert used.min() > -1
    assert all(times @ prices <= cost + 1e-6 for times, cost in all_patterns(lengths.tolist(), 16))
    assert (prices <= cutting_stock.cut_costs(lengths) + 1e-6).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 10), st.integers(1, 3)), min_size=1, max_size=4, unique_by=lambda x: x[0]), st.data())
def test_knapsack_is_the_best_choice(items, data):
    lengths, bounds = (np.array(x) for x in zip(*items))
    prices = np.array(data.draw(st.lists(st.floats(0, 20), min_size=len(items), max_size=len(items))))
    sack = cutting_stock.Knapsack(lengths, bounds, prices, 16)
    best = defaultdict(lambda: -np.inf)
    for times in product(*(range(b + 1) for b in bounds)):
        s = int(np.dot(times, lengths))
        best[s] = max(best[s], float(np.dot(times, prices)))
    for s in range(17):
        assert sack.value[s] == pytest.approx(best[s])
        if np.isfinite(best[s]):
            chosen = sack.choice(s)
            assert sum(int(lengths[i]) * k for i, k in chosen.items()) == s
            assert all(k <= bounds[i] for i, k in chosen.items())


# ---------------------------------------------------------------------- manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(doc, source, lang, n, text):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def tree_by_hand(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def manifest_by_hand(rows):
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append((row[0] is not None, row[0] or 0, leaf_by_hand(*row), row))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: tree_by_hand([leaf for _, _, leaf, _ in sorted(by_lang[lang], key=lambda r: r[:3])]) for lang in langs}
    top = tree_by_hand([trees[lang][-1][0] for lang in langs])
    root = top[-1][0]
    out = []
    for place, lang in enumerate(langs):
        for i, (_, _, leaf, row) in enumerate(sorted(by_lang[lang], key=lambda r: r[:3])):
            node = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                node = leaf_by_hand(*row[:3], row[3] + 1, row[4])
            siblings = []
            for levels, at in ((trees[lang], i), (top, place)):
                for level in levels[:-1]:
                    other = level[at ^ 1 : (at ^ 1) + 1]
                    siblings += other
                    node = H(*other, node) if at & 1 else H(node, *other)
                    at >>= 1
            out.append((row[0], leaf, trees[lang][-1][0], root, H(*siblings), node, node == root))
    return Counter(out)


COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def manifest_table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], COLUMNS + ", leaf string, rank int, branch string")


@pytest.mark.parametrize("n", [1, 2, 31, 32, 33, 64, 65, 1025, 3000])
def test_manifest_of_one_language(spark, n):
    rows = [(k * 3 - 50, "s", "en", k, f"text {k}") for k in range(n)]
    found = merkle_manifest.manifest(manifest_table(spark, rows)).collect()
    assert Counter(map(tuple, found)) == manifest_by_hand(rows)


def test_manifest_of_many_languages(spark):
    rng = np.random.default_rng(3)
    rows = [
        (int(rng.integers(0, 5000)) if k % 9 else None, [None, "", "src"][k % 3], [None, "", *"abcdefé"][int(rng.integers(0, 9))] if k % 2 else f"l{k % 83}",
         [None, 0, (1 << 63) - 1, k][k % 4], [None, "", "é漢😀", "w " * k][k % 4])
        for k in range(900)
    ]
    rows += rows[:40]  # repeated rows
    found = merkle_manifest.manifest(manifest_table(spark, rows)).collect()
    assert Counter(map(tuple, found)) == manifest_by_hand(rows)
    tampered = {r.doc_id for r in found if not r.verified}
    assert tampered and all(zlib.crc32(str(d).encode()) % 7 == 0 for d in tampered)


def test_manifest_edges(spark, edge):
    docs = edge.selectExpr("*", "if(doc_id = 9, null, source) as lang")
    rows = [(d, s, None if d == 9 else s, None if t is None else len(t), t) for d, t, s in EDGE_ROWS]
    assert Counter(map(tuple, merkle_manifest.manifest(docs).collect())) == manifest_by_hand(rows)
    nothing = merkle_manifest.manifest(docs.limit(0))
    assert nothing.collect() == [] and nothing.columns[-1] == "verified"


def test_only_some_levels_are_stored(spark):
    nodes = spark.range(5000).selectExpr(
        "0L as tree", "5000L as total", "id as rank", "sha2(string(id), 256) as digest", "id as doc_id", "string(null) as changed"
    )
    levels, roots = merkle_manifest.stored_levels(nodes, 5000, "test")
    assert [level.count() for level in levels] == [157, 5, 1]
    want = tree_by_hand([H(str(k)) for k in range(5000)])
    assert [r.digest for r in roots.collect()] == want[-1]
    assert max(r.n for r in levels[1].selectExpr("size(nodes) as n").collect()) == 1 << merkle_manifest.STRIDE

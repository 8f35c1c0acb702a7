"""Components, line dedup, SimHash groups and document fingerprints."""

from __future__ import annotations

import hashlib
import re

from collections import Counter

import numpy as np
import pytest
import xxhash

from hypothesis import given, settings
from hypothesis import strategies as st

from tripmetrics.llm import closed_syncmers, line_dedup, simhash_grid
from tripmetrics.llm.components import components

from .conftest import EDGE_ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


@pytest.mark.parametrize(
    "links",
    [
        [],
        [(1, 1)],
        [(k, k + 1) for k in range(60)],
        [(0, k) for k in range(1, 50)] + [(100, 101), (101, 99)],
        [(5, 3), (3, 5), (5, 3), (8, 9), (2, 8), (3, 2)],
    ],
)
def test_components(spark, links):
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    union = Union()
    for a, b in links:
        union.join(a, b)
    assert found == {x: union.find(x) for pair in links for x in pair if pair[0] != pair[1]}


def fingerprint_by_hand(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(rows):
    """component_id by row of (doc_id, fingerprint)."""
    prints = sorted({f for _, f in rows})
    union = Union()
    for i, a in enumerate(prints):
        union.find(a)
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                union.join(a, b)
    least = {}
    for d, f in rows:
        if d is not None:
            root = union.find(f)
            least[root] = min(least.get(root, d), d)
    return Counter((d, f"{f:016x}", least.get(union.find(f))) for d, f in rows)


def test_simhash_of_all_documents(documents, texts):
    found = simhash_grid.near_duplicates(documents).collect()
    assert Counter(map(tuple, found)) == groups_by_hand([(d, fingerprint_by_hand(t)) for d, t in texts.items()])


def test_simhash_edges(edge, nothing):
    found = simhash_grid.near_duplicates(edge).collect()
    assert Counter(map(tuple, found)) == groups_by_hand([(d, fingerprint_by_hand(t)) for d, t, _ in EDGE_ROWS])
    assert simhash_grid.near_duplicates(nothing).collect() == []


def near_pairs(rng, n):
    """Fingerprints in tight groups, some chained over several steps, among unrelated ones."""
    out = [int(x) for x in rng.integers(0, 1 << 63, n)]
    for x in out[: n // 4]:
        for _ in range(6):
            y = x
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                y ^= 1 << int(b)
            out.append(y)
            x = y if rng.random() < 0.5 else x
    return out


@pytest.mark.parametrize("block", [4096, 8])
def test_grid_loses_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(simhash_grid, "BLOCK", block)
    prints = sorted(set(near_pairs(np.random.default_rng(5), 150)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "bits long")
    found = dict(simhash_grid.fingerprint_components(nodes).collect())
    union = Union()
    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                union.join(a, b)
    want, got = {}, {}
    for p, s in zip(prints, signed):
        want.setdefault(union.find(p), set()).add(p)
        got.setdefault(found.get(s, s), set()).add(p)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 255), min_size=1, max_size=60, unique=True))
def test_links_span_in_a_long_cell(values):
    bits = np.array(values, dtype=np.uint64)
    links, union, want = simhash_grid.spanning_links(bits), Union(), Union()
    for v in values:
        union.find(v), want.find(v)
    for a, b in links:
        assert (a ^ b).bit_count() <= 3
        union.join(a, b)
    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 3:
                want.join(a, b)
    assert len(links) < len(values)
    assert all(union.find(v) == want.find(v) for v in values)


def test_one_row_of_each_group_stays(edge, documents, texts):
    left = simhash_grid.representatives(edge)
    assert left.columns == edge.columns
    groups = groups_by_hand([(d, fingerprint_by_hand(t)) for d, t, _ in EDGE_ROWS])
    assert len(left.collect()) == len({f for _, f, _ in groups})  # no two of these texts are near
    stay = {r.doc_id for r in simhash_grid.representatives(documents).collect()}
    all_groups = groups_by_hand([(d, fingerprint_by_hand(t)) for d, t in texts.items()])
    assert stay == {c for _, _, c in all_groups}


def test_a_task_fingerprints_in_one_worker(edge):
    plan = simhash_grid.representatives(edge)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def decisions_by_hand(docs):
    rows = [
        (d, n, line)
        for d, text in docs
        for n, line in enumerate((text or "").split("\n"))
        if WORD.search(line)
    ]
    lines = list(dict.fromkeys(line for _, _, line in rows))
    sets, union = [line_dedup.shingles(line) for line in lines], Union()
    for i, a in enumerate(sets):
        union.find(i)
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                union.join(i, j)
    at = {line: i for i, line in enumerate(lines)}
    order = lambda d: (d is None, d or 0)
    first = {}
    for d, n, line in sorted(rows, key=lambda r: (order(r[0]), r[1])):
        first.setdefault(union.find(at[line]), (d, n))
    return Counter((d, n, first[union.find(at[x])] == (d, n), *first[union.find(at[x])]) for d, n, x in rows)


def test_line_decisions_of_all_documents(documents, texts):
    found = Counter(map(tuple, line_dedup.line_decisions(documents).collect()))
    want = decisions_by_hand(list(texts.items()))
    assert found == want


def test_near_lines_in_a_crowded_band(spark):
    """A group whose members are near each other only in part needs the second round."""
    base = "".join(chr(97 + (i * 7 + i * i) % 26) for i in range(300))
    steps = [base[: 8 * k] + "#" * (8 * k) + base[16 * k :] for k in range(8)]
    docs = [(k, f"{line}\n{line[:-1]}?") for k, line in enumerate(steps * 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert Counter(map(tuple, line_dedup.line_decisions(df).collect())) == decisions_by_hand(docs)


#: Short and long lines of few characters, so that shingles meet; some of zeros, some past Latin-1.
LINES = st.text(alphabet="ab\0\xe9\u20ac\U0001f600", max_size=40) | st.text(alphabet="ab", max_size=60)


def jaccard_reached(a, b):
    one, two = line_dedup.shingles(a), line_dedup.shingles(b)
    return len(one & two) >= 0.8 * len(one | two)


@settings(max_examples=300, deadline=None)
@given(LINES, LINES, st.integers(0, 40))
def test_similar_lines_as_sets_of_strings(a, b, cut):
    for other in (b, a, a + b[:1], a[:cut] + b[:1] + a[cut + 1 :]):
        assert line_dedup.similar(a, other) == jaccard_reached(a, other)
        one, two = line_dedup.spelt(a), line_dedup.spelt(other)
        assert len(one) == len(line_dedup.shingles(a))
        assert line_dedup.shared(one, two) == len(line_dedup.shingles(a) & line_dedup.shingles(other))


@settings(max_examples=100, deadline=None)
@given(st.lists(LINES, min_size=2, max_size=6), st.integers(0, 20))
def test_spanning_links_of_lines_of_both_kinds(lines, cut):
    """A Latin-1 line and one with a wider character share shingles, whichever way each is held."""
    lines = list(dict.fromkeys([*lines, *(x[:cut] + "\u20ac" + x[cut:] for x in lines), *(x * 3 for x in lines)]))
    union, want = Union(), Union()
    for i, j in line_dedup.spanning_links(lines, [str(k).encode() for k in range(len(lines))]):
        assert jaccard_reached(lines[i], lines[j])
        union.join(i, j)
    for i, a in enumerate(lines):
        for j in range(i):
            if jaccard_reached(a, lines[j]):
                want.join(i, j)
    assert [union.find(i) for i in range(len(lines))] == [want.find(i) for i in range(len(lines))]


def test_line_edges(edge, nothing):
    found = Counter(map(tuple, line_dedup.line_decisions(edge).collect()))
    assert found == decisions_by_hand([(d, t) for d, t, _ in EDGE_ROWS])
    assert line_dedup.line_decisions(nothing).collect() == []
    assert line_dedup.without_repeats(nothing).collect() == []
    left = line_dedup.without_repeats(edge)
    assert left.columns == edge.columns
    texts = Counter((r.doc_id, r.text) for r in left.collect())
    assert (4, "") in texts and (3, None) in texts and (5, " \n\t \r\n") in texts


def test_rows_without_an_id_are_documents_of_their_own(spark):
    """Each loses its own repeats only, and of copies at one line number one stays."""
    docs = [
        (None, "a text that nobody else has"),
        (None, "a line that is known already\nand something of its own"),
        (3, "a line that is known already"),
        (None, "twice at the same place\nthe one and only first"),
        (None, "twice at the same place\nand quite another second"),
        (7, "one number with two texts"),
        (7, "a line that is known already\nthe other text of seven"),
        (None, "this whole row comes again"),
        (None, "this whole row comes again"),
        (None, " \n"),
        (None, " \n"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    left = [(r.doc_id, r.text) for r in line_dedup.without_repeats(df).collect()]
    lines = Counter(line for _, text in left for line in text.split("\n") if line.strip())
    assert lines == Counter({line: 1 for _, text in docs for line in text.split("\n") if line.strip()})
    assert (None, "a text that nobody else has") in left and (7, "one number with two texts") in left
    assert (None, "and something of its own") in left and (7, "the other text of seven") in left
    assert left.count((None, " \n")) == 2
    first = [r.kept for r in line_dedup.line_decisions(df.filter("text like 'twice%'")).collect() if r.line_no == 0]
    assert sorted(first) == [False, True]


def test_equal_lines_share_bands():
    lines = ["short", "short", "a longer line of text", "", "é" * 9]
    keys = line_dedup.bands(lines)
    assert keys.shape == (5, line_dedup.BANDS)
    assert (keys[0] == keys[1]).all() and not (keys[0] == keys[2]).any()
    assert (keys == np.concatenate([line_dedup.bands([x]) for x in lines])).all()


def anchors_by_hand(text, k=closed_syncmers.K, s=closed_syncmers.S):
    codes = np.array([ord(c) for c in text], dtype=np.uint64)
    inner = closed_syncmers._windows(codes, s).tolist() if len(text) >= s else []
    found = []
    for i in range(len(text) - k + 1):
        part = inner[i : i + k - s + 1]
        if min(part) in (part[0], part[-1]):
            found.append(i)
    return found


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("abcdé "), min_size=closed_syncmers.K, max_size=200))
def test_anchors_by_hand(text):
    places, hashes = closed_syncmers.anchors(text)
    assert places.tolist() == anchors_by_hand(text)
    # Context-free: the same anchors wherever the text stands.
    moved, same = closed_syncmers.anchors("zyx" + text + "wvu")
    inside = (moved >= 3) & (moved <= 3 + len(text) - closed_syncmers.K)
    assert (moved[inside] - 3).tolist() == places.tolist() and (same[inside] == hashes).all()


def compared_by_hand(docs):
    order = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = Counter()
    for k, (d, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        a, b, c = (closed_syncmers.sketch(t) for t in (text, new, following))
        out[
            (
                d,
                len(text),
                hashlib.sha256(new.encode()).hexdigest(),
                closed_syncmers.written(a),
                closed_syncmers.written(b),
                closed_syncmers.likeness(a, b),
                closed_syncmers.likeness(a, c),
            )
        ] += 1
    return out


def test_fingerprints_of_all_documents(documents, texts):
    found = closed_syncmers.fingerprint_documents(documents).collect()
    assert Counter(map(tuple, found)) == compared_by_hand(list(texts.items()))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert np.mean([r.near_edited for r in found]) > 10 * np.mean([r.near_next for r in found])


def test_fingerprint_edges(edge, nothing, spark):
    found = closed_syncmers.fingerprint_documents(edge).collect()
    assert Counter(map(tuple, found)) == compared_by_hand([(d, t) for d, t, _ in EDGE_ROWS])
    assert closed_syncmers.fingerprint_documents(nothing).collect() == []
    single = spark.createDataFrame([(7, "just one text of some length")], "doc_id long, text string")
    (row,) = closed_syncmers.fingerprint_documents(single).collect()
    assert row.near_next == 1.0


def test_anchor_table(documents, texts):
    found = closed_syncmers.anchor_table(documents.filter("doc_id < 20")).collect()
    for d in range(20):
        if d in texts:
            places, hashes = closed_syncmers.anchors(texts[d])
            assert sorted((r.place, r.anchor) for r in found if r.doc_id == d) == list(
                zip(places.tolist(), hashes.view(np.int64).tolist())
            )

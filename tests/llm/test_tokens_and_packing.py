"""Byte-level BPE by tree, packing by minimum bin slack, training order."""

from __future__ import annotations

import hashlib
import time
import zlib

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripmetrics.llm import bin_slack, bpe_tree, tokens, training_order

from .conftest import EDGE_ROWS

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LIBRARY = tokens.library_encoding(RANKS)


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def test_pattern_is_the_vocabularys_own():
    assert tokens.PATTERN == public_tokenizers.PATTERN


AWKWARD = st.text(st.sampled_from(list("ab 'sté  \n\t\rß漢😀1٣.,!\x1c\x85‍́ǅ")), max_size=120)


@settings(max_examples=150, deadline=None)
@given(AWKWARD)
def test_encoders_agree_with_the_libraries(tokenizer, text):
    want = LIBRARY.encode_ordinary(text)
    assert bpe_tree.codec(RANKS).encode(text) == want
    assert np.frombuffer(tokens.part_encoder(RANKS).encode(text), "<u4").tolist() == want
    assert tokenizer.encode(text, add_special_tokens=False).ids == want


ADDED = "<|endoftext|>"


@settings(max_examples=150, deadline=None)
@given(st.lists(AWKWARD | st.sampled_from([ADDED, "<|endof", "text|>", " "]), max_size=8).map("".join))
def test_added_tokens_have_the_librarys_ids(text):
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    want = Tokenizer.from_file(vocabulary).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(tokens.part_encoder(RANKS, vocabulary).encode(text), "<u4").tolist() == want


def test_the_query_and_the_stage_have_the_librarys_ids(spark, tmp_path):
    import corpus_pipeline

    from tripmetrics.llm.queries import QUERIES

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"a {ADDED} b", ADDED, f"{ADDED}{ADDED} x", "plain words"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for packed in (QUERIES["op10_bin_slack"](spark, str(tmp_path)), corpus_pipeline.packing(spark, docs, str(tmp_path))):
        found = {r.doc_id: (r.length, r.ids_crc32) for r in packed.collect()}
        for k, text in enumerate(texts):
            ids = np.array(library.encode(text, add_special_tokens=False).ids + [0], dtype="<u4")
            assert found[k] == (len(ids), zlib.crc32(ids.tobytes()))


@settings(max_examples=150, deadline=None)
@given(AWKWARD | st.text(st.sampled_from("ab é"), max_size=300))
def test_joins_are_exact_with_tiny_leaves(text):
    tree = bpe_tree.TreeCodec(bpe_tree.codec(RANKS).ranks)
    before = bpe_tree.SPAN, bpe_tree.PIECE
    bpe_tree.SPAN, bpe_tree.PIECE = 3, 2
    try:
        ids = tree.encode(text)
        assert ids == LIBRARY.encode_ordinary(text)
        assert tree.decode(ids) == text.encode()
    finally:
        bpe_tree.SPAN, bpe_tree.PIECE = before


def test_long_windows_use_the_heap():
    tree = bpe_tree.codec(RANKS)
    for text in ("ab" * 2000, " " * 3000 + "x", "\n" * 500, "a" * 3000):
        assert tree.encode(text) == LIBRARY.encode_ordinary(text)


def test_round_trip_of_all_documents(documents, texts):
    found = {r.doc_id: r for r in bpe_tree.round_trip_digests(documents, RANKS).collect()}
    assert found.keys() == texts.keys()
    for doc, text in texts.items():
        ids = LIBRARY.encode_ordinary(text)
        assert found[doc].n_tokens == len(ids)
        assert found[doc].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[doc].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_encode_and_decode_edges(edge, nothing):
    ids = bpe_tree.encode_documents(edge, RANKS)
    back = bpe_tree.decode_documents(ids, RANKS).collect()
    assert Counter((r.doc_id, bytes(r.bytes)) for r in back) == Counter(
        (d, (t or "").encode()) for d, t, _ in EDGE_ROWS
    )
    assert bpe_tree.round_trip_digests(nothing, RANKS).collect() == []


def pieces_by_hand(text, tokenizer, capacity=bin_slack.CAPACITY):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
    first = len(ids) % capacity or min(len(ids), capacity)
    cuts = [0, *range(first, len(ids) + 1, capacity)]
    return [
        (k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
    ]


def assert_packed(found, capacity=bin_slack.CAPACITY):
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_of_all_documents(documents, texts, tokenizer):
    found = bin_slack.pack_documents(documents, RANKS).collect()
    want = {(d, *piece) for d, t in texts.items() for piece in pieces_by_hand(t, tokenizer)}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found} == want
    assert len(found) == len(want)
    least = -(-sum(r.length for r in found) // bin_slack.CAPACITY)
    assert assert_packed(found) <= least + 1


def test_packing_edges(edge, nothing, tokenizer):
    found = bin_slack.pack_documents(edge, RANKS).collect()
    want = Counter((d, *piece) for d, t, _ in EDGE_ROWS for piece in pieces_by_hand(t, tokenizer))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    assert_packed(found)
    assert bin_slack.pack_documents(nothing, RANKS).collect() == []


def test_hot_length_is_ranked_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(bin_slack, "RANKED_TOGETHER", 7)
    pieces = spark.range(500).selectExpr(
        "id as doc_id", "0 as piece", "0L as start", "if(id % 3 = 0, 700L, id + 1) as length", "id as ids_crc32"
    )
    found = bin_slack.pack(pieces).collect()
    assert len({r.doc_id for r in found}) == len(found) == 500
    assert assert_packed(found) >= -(-sum(r.length for r in found) // bin_slack.CAPACITY)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_plan_places_every_piece_once(lengths):
    counts = np.bincount(lengths, minlength=41)
    plan = bin_slack.packing_plan(counts)
    used, filled = Counter(), Counter()
    for length, first, end, sequence, times, _ in plan:
        assert first == used[length]
        used[length] = end
        for bin_ in range((end - first) // times):
            filled[sequence + bin_] += times * length
    assert used == Counter({k: int(n) for k, n in enumerate(counts) if n})
    assert all(v <= 40 for v in filled.values())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=8), st.integers(0, 40))
def test_fullest_is_the_best_subset(lengths, room):
    best = max(s for s in (sum(x for k, x in enumerate(lengths) if m >> k & 1) for m in range(1 << len(lengths))) if s <= room)
    chosen = bin_slack.fullest(np.bincount(lengths, minlength=41), room)
    assert sum(length * times for length, times in chosen.items()) == best
    assert all(lengths.count(length) >= times for length, times in chosen.items())


@pytest.mark.parametrize("total", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_slots_are_a_permutation(total):
    found = training_order.slots(np.arange(total), total, key=7)
    assert sorted(found.tolist()) == list(range(total))
    assert np.array_equal(found[total // 2 :], training_order.slots(np.arange(total // 2, total), total, key=7))
    if total > 100:
        assert not np.array_equal(found, training_order.slots(np.arange(total), total, key=8))


def test_shards_hold_all_tokens(documents, texts, spark):
    found = training_order.training_order(documents, RANKS, key=5).collect()
    assert sorted(r.slot for r in found) == list(range(len(found)))
    assert all(r.intact for r in found)
    assert sum(r.n_tokens for r in found) == sum(len(LIBRARY.encode_ordinary(t)) + 1 for t in texts.values())
    crcs = {r.slot: r.ids_crc32 for r in found}
    first = min(found, key=lambda r: r.slot)
    stream = np.array([*LIBRARY.encode_ordinary(texts[first.doc_id]), training_order.END], "<u2")
    part = stream[first.start : first.start + first.n_tokens]
    if len(part) == first.n_tokens:
        assert zlib.crc32(part.tobytes()) == crcs[first.slot]


def test_reading_resumes_anywhere(documents, spark, tmp_path):
    path = str(tmp_path / "shards")
    training_order.write_shards(documents, RANKS, 5, path)
    everything = {r.slot: r for r in training_order.read_shards(spark, path).collect()}
    later = {r.slot: r for r in training_order.read_shards(spark, path, first_slot=100).collect()}
    assert later == {slot: r for slot, r in everything.items() if slot >= 100}


def test_training_order_edges(edge, nothing):
    found = training_order.training_order(edge, RANKS, key=1).collect()
    want = sum(len(LIBRARY.encode_ordinary(t or "")) + 1 for _, t, _ in EDGE_ROWS)
    assert sum(r.n_tokens for r in found) == want
    assert all(r.intact for r in found)
    assert training_order.training_order(nothing, RANKS, key=1).collect() == []


@pytest.mark.parametrize("parts", [1, 3])
def test_every_record_by_hand(documents, spark, tmp_path, parts):
    """Streams of the partitions cut by hand, numbered through the partitions, at the slots of the permutation."""
    path = str(tmp_path / "documents")
    documents.select("doc_id", "text").repartition(parts).write.parquet(path)
    docs = spark.read.parquet(path)
    rows = docs.selectExpr("spark_partition_id() AS part", "doc_id", "text").collect()
    cut = []
    for part in sorted({r.part for r in rows}):
        stream, origin = [], []
        for r in rows:
            if r.part == part:
                ids = [*LIBRARY.encode_ordinary(r.text or ""), training_order.END]
                stream += ids
                origin += [(r.doc_id, k) for k in range(len(ids))]
        for i in range(0, len(stream), training_order.LENGTH):
            ids = np.array(stream[i : i + training_order.LENGTH], dtype="<u2")
            cut.append((*origin[i], len(ids), zlib.crc32(ids.tobytes())))
    slot = training_order.slots(np.arange(len(cut)), len(cut), key=5).tolist()
    want = {k: (*c, True) for k, c in zip(slot, cut)}
    for per_shard in (7, training_order.PER_SHARD):
        out = str(tmp_path / f"shards-{per_shard}")
        training_order.write_shards(docs, RANKS, 5, out, per_shard)
        found = training_order.read_shards(spark, out, per_shard=per_shard).collect()
        assert {r.slot: (r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.intact) for r in found} == want
        assert all((r.shard, r.byte_offset) == (r.slot // per_shard, r.slot % per_shard * training_order.STRIDE) for r in found)


def test_shards_leave_no_shuffle_files(documents, spark, tmp_path):
    """The records' shuffles go with the range of shards that they were for; the setting stays as it was."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def shuffled() -> int:
        files = [disk.getAllFiles().apply(k) for k in range(disk.getAllFiles().size())]
        return sum(f.length() for f in files if f.getName().startswith("shuffle_") and f.getName().endswith(".data"))

    before, setting = shuffled(), spark.conf.get(key)
    path = tmp_path / "shards"
    training_order.write_shards(documents, RANKS, 5, str(path), 100)
    shards = sorted(path.glob("shard=*"), key=lambda p: int(p.name[6:]))
    assert len(shards) > training_order.PASSES and all(len([*s.glob("*.txt")]) == 1 for s in shards)
    written = sum(f.stat().st_size for s in shards for f in s.glob("*.txt"))
    for _ in range(50):  # files go a moment later
        if shuffled() - before < written / 20:
            break
        time.sleep(0.2)
    assert shuffled() - before < written / 20 and spark.conf.get(key) == setting


@pytest.mark.parametrize("rank", [training_order.END, 65_536])
def test_ranks_that_do_not_fit_are_refused(tmp_path, rank):
    path = tmp_path / "ranks"
    path.write_text(f"YQ== 0\nYg== {rank}\n")
    with pytest.raises(ValueError, match="ids past 16 bits, or uses"):
        training_order.checked_ranks(str(path))


"""Quality cascade, toxicity, secret scan and language-model scoring."""

from __future__ import annotations

import re
import zlib

from collections import Counter

import numpy as np
import pytest

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tripmetrics.llm import loss_difference, rule_cascade, secret_forest, weak_toxicity

from .conftest import EDGE_ROWS, SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {
        i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)
    }
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(repeated),
    )


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab é#|\n\t\x0b\x1c\x85 ."), max_size=60))
def test_base_counts(text):
    t = rule_cascade.Text(text)
    assert (t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words) == base_by_hand(text)


def test_cascade_on_edges(edge, nothing):
    found = rule_cascade.rule_cascade(edge).collect()
    assert Counter((r.doc_id, *r[1:6]) for r in found) == Counter((d, *base_by_hand(t)) for d, t, _ in EDGE_ROWS)
    assert not any(r.kept for r in found if r.base_failed)
    assert rule_cascade.rule_cascade(nothing).collect() == []


def test_order_changes_no_verdict(documents):
    forth = rule_cascade.judge(documents, list(rule_cascade.RULES)).collect()
    back = rule_cascade.judge(documents, list(reversed(rule_cascade.RULES))).collect()
    assert sorted(forth) == sorted(back)


def test_rules_run_by_rejections_per_second():
    figures = [("symbols", 1.0, 0.5), ("long_words", 0.1, 0.2), ("shouting", 0.2, 0.0)]
    names = [rule.name for rule in rule_cascade.ordered(figures)]
    assert names[:3] == ["long_words", "symbols", "shouting"]
    assert sorted(names) == sorted(rule.name for rule in rule_cascade.RULES)


def test_rules_are_timed_where_the_cascade_meets_them(spark):
    """A count that the base holds costs next to nothing, and texts that fail the base are no evidence."""
    rules = (
        rule_cascade.Rule("held", lambda t: 10 * t.n_dup_lines > 3 * len(t.lines)),
        rule_cascade.Rule("made", lambda t: len(set(zip(t.text, t.text[1:]))) < 0),
        rule_cascade.Rule("short", lambda t: t.n_words < 50),
    )
    long = "\n".join(" ".join(f"w{k}x{j}" for j in range(20)) for k in range(100))
    same = "\n".join(["one line of words"] * 30)  # three words in four repeat: the base fails
    rows = [(k, text) for k, text in enumerate([long, f"{long}\n{long[:90]}", same, "a few words", "", None] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {name: (seconds, share) for name, seconds, share in rule_cascade.measured(docs, rules)}
    assert found["held"][0] < found["made"][0] / 20
    assert {name: share for name, (_, share) in found.items()} == {"held": 0, "made": 0, "short": 0}
    none = rule_cascade.measured(docs.filter("text is null or text = ''"), rules)
    assert [(name, share) for name, _, share in none] == [(rule.name, 0) for rule in rules]


def test_good_documents_stay_and_junk_goes(documents, spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    found = {r.doc_id: r for r in rule_cascade.rule_cascade(documents).collect()}
    good = [found[d] for d, q in labels.items() if q == 1 and not found[d].base_failed]
    assert good and all(r.kept for r in good)
    junk = [found[d] for d, q in labels.items() if q == 0 and found[d].n_symbols > found[d].n_words]
    assert not any(r.kept for r in junk)


def test_held_out_is_the_crc(spark):
    ids = [*range(200), -5, 10**12]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    found = dict(df.select("doc_id", weak_toxicity.learnable(df.doc_id)).collect())
    assert found == {i: zlib.crc32(str(i).encode()) % 5 != 0 for i in ids}


def test_label_model_finds_accuracies_and_copies():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.3

    def voter(right):
        return np.where(rng.random(len(truth)) < right, truth, ~truth).astype(int)

    a, b, c, d = voter(0.95), voter(0.85), voter(0.8), voter(0.7)
    copy = np.where(rng.random(len(truth)) < 0.9, d, voter(0.7))
    votes, n = np.unique(np.stack([a, b, c, d, copy], axis=1), axis=0, return_counts=True)
    known = rng.random(len(truth)) < 0.02
    labelled = np.zeros((2, len(votes)))
    index = {tuple(v): k for k, v in enumerate(votes.tolist())}
    for row, y in zip(np.stack([a, b, c, d, copy], axis=1)[known].tolist(), truth[known]):
        labelled[int(y), index[tuple(row)]] += 1
    model = weak_toxicity.LabelModel().fit(votes, n.astype(float), labelled)
    assert np.allclose(model.accuracies[:3], [0.95, 0.85, 0.8], atol=0.04)
    assert any({3, 4} <= set(clique) for clique in model.cliques)
    posterior = dict(zip(map(tuple, votes.tolist()), model.posterior(votes)))
    said = np.array([posterior[tuple(r)] for r in np.stack([a, b, c, d, copy], axis=1).tolist()]) >= 0.5
    assert (said == truth).mean() > 0.95


@pytest.fixture(scope="module")
def labelled_documents(spark):
    path = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")


def test_toxicity_held_out_accuracy(labelled_documents):
    docs, labels = labelled_documents
    found = {r.doc_id: r for r in weak_toxicity.toxicity(docs, labels).collect()}
    assert len(found) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    truth = [(r.toxic, found[r.doc_id].predicted) for r in labels.collect() if found[r.doc_id].held_out]
    assert sum(a == b for a, b in truth) / len(truth) > 0.92
    clean = [p for t, p in truth if t == 0]
    assert sum(clean) / len(clean) < 0.04


def test_toxicity_edges(edge, nothing, labelled_documents, spark):
    docs, labels = labelled_documents
    model = weak_toxicity.train(docs.select("doc_id", "text"), labels)
    left = weak_toxicity.without(edge, model)
    assert left.columns == edge.columns
    assert Counter(map(tuple, edge.collect())) - Counter(map(tuple, left.collect())) == Counter(
        tuple(r) for r in edge.filter("doc_id = 8").collect()
    )
    few = weak_toxicity.toxicity(edge, labels.limit(0)).collect()
    assert len(few) == len(EDGE_ROWS) and all(r.score == 0 for r in few)
    assert weak_toxicity.toxicity(nothing, labels).collect() == []
    stay = weak_toxicity.without_toxic(edge, labels.limit(0))
    assert stay.columns == edge.columns and stay.count() == len(EDGE_ROWS)


def test_candidates_are_those_of_the_pattern(documents, texts):
    docs = documents.selectExpr("doc_id", "text", "source as path")
    found = secret_forest.candidates(docs).collect()
    pattern = re.compile(r"(?<![A-Za-z0-9_+/=\-])[A-Za-z0-9_+/=\-]{16,}")
    want = {
        (d, k, m[0], t[max(0, m.start() - 8) : m.start()])
        for d, t in texts.items()
        for k, m in enumerate(pattern.finditer(t))
    }
    assert {(r.doc_id, r.ordinal, r.value) for r in found} == {w[:3] for w in want}
    for d, k, value, before in want:
        r = next(r for r in found if (r.doc_id, r.ordinal) == (d, k))
        assert r.before.endswith(before[-8:].rsplit(value, 1)[-1][-1:])


def test_secrets_are_found_and_lookalikes_are_not(labelled_documents, spark):
    docs, _ = labelled_documents
    found = secret_forest.scan(docs).collect()
    said = {(r.doc_id, r.value) for r in found if r.secret}
    want = {
        (r.doc_id, m)
        for r in docs.collect()
        for m in re.findall(r'(?i)token = "([0-9a-f]{40})"', r.text)
    }
    assert want <= said and len(said - want) <= 1


def test_secret_edges(edge, nothing, labelled_documents):
    docs, _ = labelled_documents
    assert secret_forest.scan(nothing).collect() == []
    clean = secret_forest.redacted(edge)
    assert clean.columns == edge.columns and clean.count() == len(EDGE_ROWS)
    left = secret_forest.redacted(docs)
    gone = {r.doc_id: r for r in left.collect()}
    for r in docs.collect():
        marked = re.sub(r'(?i)(?<=token = ")[0-9a-f]{40}(?=")', "<secret>", r.text)
        if marked != r.text:
            assert gone[r.doc_id].text == marked and gone[r.doc_id].n_chars == len(marked)


ASSIGNED = [
    ('aws_secret_access_key = "wJalrXUtnFEMI/K7MDENG/bPxRfiCY{:04d}KEY"', "wJalrXUtnFEMI/K7MDENG/bPxRfiCY{:04d}KEY"),
    ("GITHUB_TOKEN=ghp_16C7e42F292c6912E7710c838347{:04d}", "ghp_16C7e42F292c6912E7710c838347{:04d}"),
    ("service_account_password: hT7yQ29vLm4XzR8w{:04d}", "hT7yQ29vLm4XzR8w{:04d}"),
]


def test_names_beside_values(spark, documents):
    """A long name is text before the value, whether it is a candidate of its own or the head of one."""
    texts = [line.format(k) for k in range(5) for line, _ in ASSIGNED]
    rows = [(k, f"some words\n{text}\nmore words", "app/settings") for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.value: r for r in secret_forest.candidates(docs.withColumnRenamed("source", "path")).collect()}
    for line, value in ASSIGNED:
        head = line.format(3).split(value.format(3))[0]
        assert found[value.format(3)].before.endswith(head) and found[value.format(3)].after.strip('"').startswith("\nmore")
    labels = {r.value: r.label for r in secret_forest.labelled_findings(secret_forest.candidates(docs.withColumnRenamed("source", "path"))).collect() if r.before.startswith("some words")}
    assert all(labels[value.format(3)] == 1 for _, value in ASSIGNED)
    every = documents.select("doc_id", "text", "source").union(docs.selectExpr("doc_id + 1000000", "text", "source"))
    left = {r.doc_id: r.text for r in secret_forest.redacted(every).collect()}
    for k, (line, value) in enumerate(ASSIGNED):
        want = line.format(0).replace(value.format(0), "<secret>")
        assert left[1_000_000 + k] == f"some words\n{want}\nmore words"


def test_text_beside_holds_other_candidates(spark):
    text = "first " + "a" * 20 + " " + "b" * 20 + "." + "c" * 20 + " " + "d" * 70 + " last"
    docs = spark.createDataFrame([(1, text, None)], "doc_id long, text string, path string")
    for r in secret_forest.candidates(docs).collect():
        at = text.index(r.value)
        end = at + len(r.value)
        assert (r.before, r.after) == (text[max(0, at - 48) : at], text[end : end + 48])


RARE = 'token = "4f9a1c0de8b7263554aa01bc9e8f7d6c5b4a3f21"'


def test_rare_secrets_are_found(spark):
    """One secret in many thousand documents gives a model, and is found."""
    plain = F.concat(F.lit("see the page some_long_name_of_a_file_"), F.col("id"), F.lit(" for more"))
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") == 17_003, F.lit(RARE)).otherwise(plain).alias("text"), F.lit("a/b").alias("source")
    )
    assert [r.doc_id for r in secret_forest.scan(docs).filter("secret").collect()] == [17_003]


def test_rare_letter_pairs_of_a_large_input_have_a_likelihood(spark, monkeypatch):
    """Billions of letter pairs, as over 6 GB of documents: one that no word holds still has a likelihood above 0."""
    times, kept = 10**7, secret_forest.kept

    def many(df, name, **options):
        df = kept(df, name, **options)
        return df.withColumn("count", F.col("count") * times) if name == "dictionary" else df

    monkeypatch.setattr(secret_forest, "kept", many)
    rows = [(k, f"see the page some_long_name_of_a_file_{k} for more", "a/b") for k in range(300)] + [(300, RARE, "a/b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    counts = Counter(w[i : i + 2] for w in ("see", "the", "page", "for", "more") * 300 for i in range(len(w) - 1))
    counts.update(("to", "ok", "ke", "en"))  # of the secret's name
    every = times * counts.total() + 26**2
    letters = "abcdefghijklmnopqrstuvwxyz"
    want = [(times * counts[a + b] + 1) / every * 26**2 for a in letters for b in letters]
    pairs, _ = secret_forest.dictionary(docs)
    assert min(pairs) > 0 and pairs == pytest.approx(want, rel=1e-9)
    found = secret_forest.scan(docs).collect()
    assert len(found) == 301 and [r.doc_id for r in found if r.secret] == [300]


def test_secret_scan_runs_no_python(documents):
    plan = secret_forest.scan(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def words_by_hand(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]


def losses_by_hand(texts, target):
    """(target loss, background loss) of each text; ``target`` holds the places of the target's texts."""
    pairs = [list(zip(["", *w], w)) for w in map(words_by_hand, texts)]
    both = [Counter(p for k in chosen for p in pairs[k]) for chosen in (target, range(len(texts)))]
    befores, singles = [Counter(), Counter()], [Counter(), Counter()]
    for side, counts in enumerate(both):
        for (a, b), n in counts.items():
            befores[side][a] += n
            singles[side][b] += n
    totals = [sum(s.values()) for s in singles]

    def loss(side, a, b):
        one = singles[side][b] + loss_difference.PRIOR * singles[1][b] / totals[1]
        one /= totals[side] + loss_difference.PRIOR
        if not befores[side][a]:
            return -np.log2(one)
        weight = loss_difference.LAMBDA
        return -np.log2(weight * both[side][a, b] / befores[side][a] + (1 - weight) * one)

    return [tuple(sum(loss(side, *p) for p in ps) / max(len(ps), 1) for side in (0, 1)) for ps in pairs]


@pytest.mark.parametrize("block_bytes", [loss_difference.BLOCK_BYTES, 50_000])
def test_losses_by_hand(documents, texts, spark, block_bytes):
    """Every word counts, however rare, and the size of blocks changes nothing."""
    ids = sorted(texts)
    good = spark.createDataFrame([(d,) for d in ids[::3]], "doc_id long")
    found = {r.doc_id: r for r in loss_difference.loss_difference(documents, good, block_bytes).collect()}
    assert found.keys() == texts.keys()
    for d, (a, b) in zip(ids, losses_by_hand([texts[d] for d in ids], range(0, len(ids), 3))):
        assert found[d].target_loss == pytest.approx(a, abs=1e-9)
        assert found[d].background_loss == pytest.approx(b, abs=1e-9)
        assert found[d].score == pytest.approx(a - b, abs=1e-9)
        assert found[d].n_words == len(words_by_hand(texts[d]))


def test_rare_words_tell_documents_apart(spark, documents, texts):
    """Two copies of a text in words of their own: the background has seen their pairs, the target has not."""
    own = " ".join(f"xq{k * k}zj" for k in range(200))
    copies = spark.createDataFrame([(-1, own), (-2, own)], "doc_id long, text string")
    every = documents.select("doc_id", "text").unionByName(copies)
    found = {r.doc_id: r.score for r in loss_difference.loss_difference(every, documents.select("doc_id")).collect()}
    assert min(found[-1], found[-2]) > 5 + max(s for d, s in found.items() if d >= 0)


def test_texts_are_shuffled_once(spark):
    """Counting and scoring read one exchange of the texts."""
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    found = loss_difference.loss_difference(docs, labels.filter("quality = 1"))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert "ReusedExchange" in final
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_loss_edges(edge, nothing):
    found = loss_difference.loss_difference(edge, edge.filter("doc_id = 1").select("doc_id")).collect()
    assert Counter((r.doc_id, r.n_words) for r in found) == Counter(
        (d, len(WORD.findall(t or ""))) for d, t, _ in EDGE_ROWS
    )
    assert all(r.score == 0 for r in found if r.n_words == 0)
    assert loss_difference.loss_difference(nothing, nothing).collect() == []
    no_target = loss_difference.loss_difference(edge, nothing).collect()
    assert all(np.isfinite(r.target_loss) for r in no_target)


@pytest.mark.parametrize("text", ["k=" * 100_000 + "A" * 20, "-=" * 100_000, "=" * 50_000, "a+" * 50_000 + "=" * 20, "k=" * 8 + "B" * 15, "n=v+w=" + "C" * 30])
def test_names_of_any_length_are_cut_off(spark, text):
    """No text ends the executor, and the name is what the pattern with a repeated group would find."""
    df = spark.createDataFrame([(text,)], "value string")
    found = df.select(F.regexp_extract("value", secret_forest.NAME, 0)).first()[0]
    key = r"[A-Za-z0-9_+/=\-]"
    cuts = [m.end() for m in re.finditer(r"=(?=[^=])", text) if len(text) - m.end() >= 16]
    heads = [c for c in cuts if re.fullmatch(r"[A-Za-z0-9_/\-][A-Za-z0-9_/\-=]*", text[:c])]
    assert re.fullmatch(f"{key}+", text) and found == (text[: heads[-1]] if heads else "")


def test_redaction_splits_each_text_once(spark, documents):
    """50,000 candidates beside a secret: linear, and only the secret goes."""
    many = " ".join(f"name_of_a_file_number_{k:06d}" for k in range(50_000))
    rows = [(-1, f"{many}\n{RARE}\n{many}", "a/b"), (-2, "k=" * 100_000 + "A" * 20, "a/b"), (-3, "-=" * 3000, None)]
    long = spark.createDataFrame(rows, "doc_id long, text string, source string")
    every = documents.select("doc_id", "text", "source").unionByName(long)
    left = {r.doc_id: r.text for r in secret_forest.redacted(every).filter("doc_id < 0").collect()}
    assert left[-1] == f"{many}\n" + RARE.replace(RARE.split('"')[1], "<secret>") + f"\n{many}"
    assert left[-3] == rows[2][1]
    changed = secret_forest.redacted(every).selectExpr("count(*)").collect()
    assert changed[0][0] == every.count()

"""Toxicity by weak supervision.

Voters are lexicons (a public one, and tiers of words and word beginnings mined from labelled
documents) and patterns; each says toxic, clean or nothing. A generative label model is fitted to how
often each combination of votes occurs over all documents: it estimates the voters' accuracies, finds
voters that agree beyond what the class explains, and models such voters jointly. Its posteriors are
the labels on which a linear classifier over words is trained, and that classifier scores texts.
"""

from __future__ import annotations

import math
import re

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import drawn, fraction_for, kept

#: Labelled documents that lexicons and classifier learn from (about); a bound, not a share.
LABELLED = 20_000
#: Words and word beginnings that are mined from them.
MINED = 4000
#: Letters of a word beginning.
BEGINNINGS = (5, 7)

#: Insults of plain English, from general knowledge (fixed values).
PUBLIC_LEXICON = (
    "bastard", "clown", "creep", "degenerate", "despicable", "disgusting", "dumb", "fool", "garbage",
    "idiot", "idiots", "imbecile", "jerk", "loser", "losers", "moron", "morons", "parasite",
    "pathetic", "pig", "scum", "stupid", "trash", "ugly", "vermin", "vile", "worthless",
)
#: Address to a reader shortly before an insult counts as a pattern of its own.
_ADDRESS = r"\b(you|your|you're|tu|du|ihr|vous|eres|usted)\b\W+(\w+\W+){0,3}"
_ADDRESSED = re.compile(_ADDRESS + "(" + "|".join(PUBLIC_LEXICON) + r")\b")

#: Votes.
CLEAN, TOXIC, SILENT = 0, 1, 2
VOTERS = ("public", "address", "sure", "likely", "hint", "several", "dense", "none")
#: Tiers of mined words: the share of toxic documents among those that hold the word.
TIERS = {"sure": (0.9, 1.1), "likely": (0.6, 0.9), "hint": (0.0, 0.6)}
#: A text is dense from this share of its words on (mined words of the upper two tiers, or of all).
DENSE = (0.015, 0.04)
#: A density in per cent counts up to this.
DENSEST = 20.0

_WORD = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> set[str]:
    """Distinct words of letters in lower case, and the beginnings (marked ^) of longer words."""
    words = set(_WORD.findall((text or "").lower()))
    starts = {"^" + word[:n] for n in BEGINNINGS for word in words if len(word) > n}
    return words | starts


def learnable(doc_id: Column) -> Column:
    """Rows whose label may be learnt from; the others are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def mined_words(sample: DataFrame) -> list[tuple[str, float, int]]:
    """(word, share of toxic documents, toxic documents) of words that toxic documents favour.

    At most MINED, those with the largest likelihood ratio first. The share is smoothed towards
    the share of toxic documents in the sample.
    """
    totals = sample.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    toxic, every = float(totals[0] or 0), float(totals[1] or 0)
    if not toxic or toxic == every:
        return []
    base = toxic / every
    counts = (
        sample.select(F.explode("tokens").alias("word"), "toxic")
        .groupBy("word")
        .agg(F.sum("toxic").cast("double").alias("t"), F.count(F.lit(1)).cast("double").alias("n"))
        .filter("t >= 2")
        .withColumn("share", (F.col("t") + base) / (F.col("n") + 1))
        .filter(F.col("share") > 2 * base)
    )
    gain = F.col("t") * F.log(F.col("share") / base) + (F.col("n") - F.col("t")) * F.log(
        (1 - F.col("share") + 1e-9) / (1 - base)
    )
    rows = counts.withColumn("gain", gain).orderBy(F.desc("gain"), "word").limit(MINED)
    return [(r.word, r.share, int(r.t)) for r in rows.collect()]  # bounded by MINED


class Lexicons:
    """The mined words by tier, and what they say about a text."""

    def __init__(self, mined: list[tuple[str, float, int]]):
        self.tiers = [{w for w, share, _ in mined if low <= share < high} for low, high in TIERS.values()]
        self.public = set(PUBLIC_LEXICON)
        self.vocabulary = sorted(self.public.union(*self.tiers))

    def hits(self, found: set[str]) -> list[int]:
        return [len(found & tier) for tier in self.tiers]

    def densities(self, found: set[str]) -> list[float]:
        return [min(100.0 * n / max(len(found), 1), DENSEST) for n in self.hits(found)]

    def code(self, text: str | None, found: set[str]) -> int:
        """All voters' votes on one text as one number, base 3."""
        sure, likely, hint = self.hits(found)
        size = max(len(found), 1)
        public = not self.public.isdisjoint(found)
        address = public and _ADDRESSED.search((text or "").lower()) is not None
        dense = sure + likely >= max(1, DENSE[0] * size) or sure + likely + hint >= max(1, DENSE[1] * size)
        says = (
            TOXIC if public else SILENT,
            TOXIC if address else SILENT,
            TOXIC if sure else SILENT,
            TOXIC if likely else SILENT,
            TOXIC if hint else SILENT,
            TOXIC if sure + likely >= 2 else CLEAN,
            TOXIC if dense else CLEAN,
            SILENT if sure + likely + hint or public else CLEAN,
        )
        code = 0
        for vote in says:
            code = 3 * code + vote
        return code


def unpacked(codes: np.ndarray, voters: int = len(VOTERS)) -> np.ndarray:
    return np.stack([codes // 3**k % 3 for k in reversed(range(voters))], axis=1)


class LabelModel:
    """Two latent classes; within a class, cliques of voters are independent of each other."""

    def __init__(self, rounds: int = 100, linked: float = 0.3, most: int = 3):
        self.rounds, self.linked, self.most = rounds, linked, most

    def _states(self, votes: np.ndarray) -> list[np.ndarray]:
        return [sum(votes[:, v] * 3**k for k, v in enumerate(clique)) for clique in self.cliques]

    def _fit_cliques(self, votes: np.ndarray, n: np.ndarray, labelled: np.ndarray, q: np.ndarray) -> np.ndarray:
        states = self._states(votes)
        for _ in range(self.rounds):
            weight = np.stack([n * (1 - q), n * q]) + labelled
            self.prior = weight.sum(axis=1) / weight.sum()
            self.tables = []
            for clique, state in zip(self.cliques, states):
                size = 3 ** len(clique)
                table = np.stack([np.bincount(state, w, size) for w in weight]) + 0.5 / size
                self.tables.append(table / table.sum(axis=1, keepdims=True))
            new = self.posterior(votes)
            done, q = np.abs(new - q).max(initial=0) < 1e-6, new
            if done:
                break
        return q

    def fit(self, votes: np.ndarray, n: np.ndarray, labelled: np.ndarray) -> LabelModel:
        """``n`` documents and ``labelled`` (clean, toxic) labelled ones cast each row of votes.

        Labels anchor the classes: all labelled documents weigh as much as all documents.
        """
        voters = votes.shape[1]
        labelled = labelled * (n.sum() / max(labelled.sum(), 1.0))
        self.cliques = [[v] for v in range(voters)]
        share = (labelled[1] + 0.1) / (labelled.sum(axis=0) + 1.0)
        said = (votes == TOXIC).sum(axis=1) / voters
        q = np.where(labelled.sum(axis=0) > 0, share, said)
        q = self._fit_cliques(votes, n, labelled, q)
        self.accuracies = [self._accuracy(table) for table in self.tables]
        self.correlations = self._correlations(votes, np.stack([n * (1 - q), n * q]) + labelled)
        for value, a, b in sorted(
            ((abs(self.correlations[a, b]), a, b) for a in range(voters) for b in range(a)), reverse=True
        ):
            one, two = (next(c for c in self.cliques if v in c) for v in (a, b))
            if value >= self.linked and one is not two and len(one) + len(two) <= self.most:
                one.extend(two)
                self.cliques.remove(two)
        self._fit_cliques(votes, n, labelled, q)
        return self

    def _accuracy(self, table: np.ndarray) -> float:
        right = self.prior[0] * table[0, CLEAN] + self.prior[1] * table[1, TOXIC]
        wrong = self.prior[0] * table[0, TOXIC] + self.prior[1] * table[1, CLEAN]
        return float(right / (right + wrong))

    @staticmethod
    def _correlations(votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Of toxic votes within a class, averaged over the classes by their weight."""
        x = (votes == TOXIC).astype(float)
        total = np.zeros((x.shape[1], x.shape[1]))
        for w in weight:
            mean = w @ x / max(w.sum(), 1e-9)
            cov = (x - mean).T @ ((x - mean) * w[:, None]) / max(w.sum(), 1e-9)
            sd = np.sqrt(np.diag(cov))
            total += w.sum() * cov / np.maximum(np.outer(sd, sd), 1e-9)
        return total / max(weight.sum(), 1e-9)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of toxic for each row of votes."""
        log = np.log(np.maximum(self.prior, 1e-12))[:, None] + sum(
            np.log(table[:, state]) for table, state in zip(self.tables, self._states(votes))
        )
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))


def fitted_label_model(codes: DataFrame, labelled: DataFrame) -> dict[int, float]:
    """Posterior by vote code, from the counts (code, n) over all documents and the labelled ones."""
    n = {r.code: r.n for r in codes.groupBy("code").agg(F.sum("n").alias("n")).collect()}  # at most 3 ** voters
    known = {(r.code, r.toxic): r["count"] for r in labelled.groupBy("code", "toxic").count().collect()}
    keys = np.array(sorted({*n, *(code for code, _ in known)}), dtype=np.int64)
    if not len(keys):
        return {}
    counts = np.array([n.get(k, 0) for k in keys.tolist()], dtype=float)
    labels = np.array([[known.get((k, c), 0) for k in keys.tolist()] for c in (0, 1)], dtype=float)
    matrix = unpacked(keys)
    model = LabelModel().fit(matrix, counts, labels)
    return dict(zip(keys.tolist(), model.posterior(matrix).tolist()))


class Classifier(NamedTuple):
    """A linear classifier over which words occur and how dense each tier is."""

    lexicons: Lexicons
    weights: dict[str, float]
    of_densities: list[float]
    intercept: float

    def score(self, text: str | None) -> float:
        found = tokens(text)
        margin = self.intercept + sum(self.weights[w] for w in found if w in self.weights)
        for weight, density in zip(self.of_densities, self.lexicons.densities(found)):
            margin += weight * density
        return 1 / (1 + math.exp(-margin)) if margin > -500 else 0.0


def _learnt_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``toxic``, ``text`` and ``tokens`` of about LABELLED documents whose label may be learnt from."""
    usable = (
        labels.filter(learnable(F.col("doc_id")) & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    share = fraction_for(LABELLED, usable.count())
    few = F.broadcast(usable.filter(drawn(share, "doc_id")))  # about LABELLED rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(tokens(text.as_py())) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.string()))],
                names=["toxic", "text", "tokens"],
            )

    drawn_docs = docs.join(few, "doc_id").select("toxic", "text")
    return kept(drawn_docs.mapInArrow(run, "toxic int, text string, tokens array<string>"), "labelled")


def _voted(sample: DataFrame, lexicons: Lexicons) -> DataFrame:
    """The sample with the votes and densities of each text instead of the text, stored: every round of the
    training reads it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                toxic, texts, words = batch.slice(at, 500).columns
                found = [set(w) for w in words.to_pylist()]
                codes = [lexicons.code(t.as_py(), w) for t, w in zip(texts, found)]
                columns = [toxic, words, pa.array(codes, pa.int32()), pa.array([lexicons.densities(w) for w in found], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["toxic", "tokens", "code", "density"])

    columns = "toxic int, tokens array<string>, code int, density array<double>"
    return kept(sample.select("toxic", "text", "tokens").mapInArrow(run, columns), "voted")


def vote_counts(docs: DataFrame, lexicons: Lexicons) -> DataFrame:
    """``code`` and ``n``: how many of the texts cast each combination of votes, by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        for batch in batches:
            for value in batch.column(0):
                text = value.as_py()
                code = lexicons.code(text, tokens(text))
                counts[code] = counts.get(code, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.int32()), pa.array(counts.values(), pa.int64())], names=["code", "n"]
        )

    return docs.select("text").mapInArrow(run, "code int, n long")


def train(docs: DataFrame, labels: DataFrame) -> Classifier | None:
    """The classifier; None where no learnable label is toxic or none is clean."""
    # Not above: Python workers import this module for the texts, and need none of it.
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel, VectorAssembler

    sample = _learnt_sample(docs, labels)
    mined = mined_words(sample)
    if not mined:
        return None
    lexicons = Lexicons(mined)

    sample = _voted(sample, lexicons)
    posterior = fitted_label_model(vote_counts(docs, lexicons), sample)
    by_code = sample.sparkSession.createDataFrame(list(posterior.items()), "code int, p double")
    soft = F.explode(
        F.array(
            F.struct(F.lit(1.0).alias("label"), F.col("p").alias("weight")),
            F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("weight")),
        )
    )
    names = [f"density_{name}" for name in TIERS]
    rows = sample.join(F.broadcast(by_code), "code").select(
        "tokens", *(F.col("density")[k].alias(name) for k, name in enumerate(names)), soft.alias("soft")
    )
    # The sample is bounded, and every iteration is a job over it: few tasks do.
    rows = rows.select("*", "soft.*").filter("weight > 0").coalesce(4)
    counter = CountVectorizerModel.from_vocabulary(lexicons.vocabulary, inputCol="tokens", outputCol="present")
    assembler = VectorAssembler(inputCols=["present", *names], outputCol="features")
    linear = LogisticRegression(
        weightCol="weight", regParam=2e-4, elasticNetParam=0.5, maxIter=100, standardization=False
    ).fit(assembler.transform(counter.setBinary(True).transform(rows)))
    weights = linear.coefficients.toArray().tolist()
    words = {w: x for w, x in zip(lexicons.vocabulary, weights) if x}
    return Classifier(lexicons, words, weights[len(lexicons.vocabulary) :], float(linear.intercept))


def _scored(texts: pa.Array, model: Classifier | None) -> list[float]:
    """Scores of a batch, one text in Python at a time; without a model 0."""
    return [model.score(text.as_py()) if model else 0.0 for text in texts]


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of (doc_id, text).

    Labels (doc_id, toxic) are learnt from where crc32(doc_id) mod 5 is not 0 only; several labels
    of a document count as the highest; null labels and ids say nothing. A null doc_id is scored and
    counts as not held out, a null text is scored as an empty one, texts are scored whole at any length,
    equal texts alike; repeated rows stay repeated; other columns are not looked at.
    """
    docs = docs.select("doc_id", "text")
    model = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(_scored(batch.column(1), model), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["doc_id", "score"])

    held_out = ~F.coalesce(learnable(F.col("doc_id")), F.lit(True))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` less the documents that the classifier calls toxic; all columns stay.

    Rows go through as they are, in Arrow batches that a mask filters. Null and empty texts, null ids
    and repeated rows count as in ``toxicity``; without a model every row stays.
    """
    return without(docs, train(docs.select("doc_id", "text"), labels))


def without(docs: DataFrame, model: Classifier | None) -> DataFrame:
    """``docs`` less those that a trained classifier calls toxic."""
    if model is None:
        return docs
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([score < 0.5 for score in _scored(batch.column(at), model)], pa.bool_()))

    # By position: column names may hold any character, dots too.
    plain = docs.toDF(*[f"_{k}" for k in range(len(docs.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)

"""Secret scanning with a random forest that removes false positives.

Long runs of key characters are candidates. A forest over a candidate's length, its character
transitions, how much of it dictionary words cover, its path and the words beside it says which are
secrets. It is trained from labelled findings. All of it is DataFrame expressions and Spark's own
forest; candidates are scored where their text is read, without a shuffle.

The dictionary is counted over all documents: their short words. From it come two tables of fixed
size, the letter pairs (26 by 26, log-likelihoods) and the letter triples (26 cubed, known or not).
"""

from __future__ import annotations

import json

from functools import reduce
from operator import or_

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import BLANKS, drawn, fraction_for, kept, own_columns, unused, with_length

#: Characters of keys and tokens, and how many in a row make a candidate.
KEY_CHARACTERS = r"A-Za-z0-9_+/=\-"
SHORTEST = 16
CANDIDATE = rf"(?<![{KEY_CHARACTERS}])[{KEY_CHARACTERS}]{{{SHORTEST},}}+"
#: What a candidate begins with that is a name and no value, if a whole candidate is left after it.
#: One run of characters, without a repeated group, which would be matched by recursion.
NAME = rf"^[A-Za-z0-9_/\-][A-Za-z0-9_/\-=]*=(?=[^=][{KEY_CHARACTERS}]{{{SHORTEST - 1},}}$)"
#: Characters of text kept on either side of a candidate.
BESIDE = 48
#: Different findings (about) of each label that the forest learns from, drawn from all documents;
#: bounds, not shares, so rare secrets are all among them.
LABELLED = {1.0: 2000, 0.0: 20_000}
#: Findings of a label that the forest is given at least, by repeating them.
FEWEST = 200
#: A dictionary word has three to six letters and makes up at least this share of such words.
COMMON_WORD = 2e-7

#: Words beside a candidate that speak for or against a secret (fixed values).
SECRET_WORDS = ("api", "auth", "bearer", "credential", "key", "passwd", "password", "pwd", "secret", "token")
HARMLESS_WORDS = ("checksum", "commit", "digest", "etag", "example", "hash", "id", "md5", "placeholder", "sha1", "sha256", "test", "uuid")
HARMLESS_PATH = r"(?i)(^|[/_.-])(doc|docs|example|examples|fixture|fixtures|mock|sample|test|tests|vendor)([/_.-]|$)"
CONFIG_PATH = r"(?i)(\.(cfg|conf|env|ini|json|pem|properties|toml|ya?ml)$|(^|/)\.env)"

FEATURES = (
    "length", "digits", "uppers", "symbols", "classes_change", "hex", "distinct", "transition", "covered",
    "path_depth", "path_harmless", "path_config", "secret_word", "harmless_word", "assigned", "quoted",
)


def _named(candidate: Column) -> Column:
    """The NAME= that a candidate begins with, or nothing."""
    return F.regexp_extract(candidate, NAME, 0)


def candidates(docs: DataFrame) -> DataFrame:
    """``row`` (doc_id, path), ``ordinal``, ``value`` and the text on either side of each candidate.

    The text between the candidates is what splitting by the pattern leaves, so the n-th candidate
    stands between the pieces n and n + 1. A NAME= at its head belongs to the text before. Text on
    either side holds the other candidates too; the nearest three are BESIDE characters or more.
    """
    text = F.coalesce("text", F.lit(""))
    cut = docs.select(
        "doc_id",
        "path",
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("values"),
        F.split(text, CANDIDATE).alias("between"),
    ).filter(F.size("values") > 0)
    near = range(-(-BESIDE // SHORTEST))

    def piece(name: str, i: Column) -> Column:
        return F.coalesce(F.get(name, i), F.lit(""))

    def end(c: Column) -> Column:
        return F.substring(c, -BESIDE, BESIDE)

    def start(c: Column) -> Column:
        return F.substring(c, 1, BESIDE)

    def finding(whole: Column, i: Column) -> Column:
        name = _named(whole)
        earlier = [end(piece(n, i - k - int(n == "values"))) for k in near for n in ("between", "values")]
        later = [start(piece(n, i + k + 1)) for k in near for n in ("between", "values")]
        return F.struct(
            i.alias("ordinal"),
            F.substr(whole, F.length(name) + 1).alias("value"),
            end(F.concat(*reversed(earlier), name)).alias("before"),
            start(F.concat(*later)).alias("after"),
        )

    return cut.select("doc_id", "path", F.explode(F.transform("values", finding)).alias("found")).select(
        "doc_id", "path", "found.*"
    )


def dictionary(docs: DataFrame) -> tuple[list[float], list[int]]:
    """Letter-pair log-likelihoods and known letter triples, from the short words of all texts.

    676 and 17,576 numbers, whatever the input.
    """
    words = docs.select(F.explode(F.split(F.lower("text"), BLANKS)).alias("word"))
    counted = words.filter(F.col("word").rlike("^[a-z]{3,6}$")).groupBy("word").count()
    counted = kept(counted, "dictionary")
    total = counted.agg(F.sum("count")).first()[0] or 0
    common = counted.filter(F.col("count") >= max(2.0, COMMON_WORD * total))

    def grams(width: int) -> DataFrame:
        places = F.sequence(F.lit(1), F.length("word") - width + 1)
        return common.select(
            F.explode(F.transform(places, lambda i: F.substr("word", i, F.lit(width)))).alias("gram"), "count"
        )

    def place(gram: str) -> int:
        at = 0
        for letter in gram:
            at = 26 * at + ord(letter) - ord("a")
        return at

    pairs = [0.0] * 26**2
    for gram, n in grams(2).groupBy("gram").agg(F.sum("count")).collect():
        pairs[place(gram)] = float(n)
    every = sum(pairs) + len(pairs)
    known = [0] * 26**3
    for row in grams(3).select("gram").distinct().collect():
        known[place(row.gram)] = 1
    likely = [(n + 1) / every * len(pairs) for n in pairs]
    short = [round(x, 6) for x in likely]
    # Over a large input a rare pair would become 0, which has no logarithm: then none is rounded.
    return short if all(short) else likely, known


def _numbers(values: list, kind: str) -> Column:
    """A constant array, written as one literal."""
    return F.split(F.lit(json.dumps(values, separators=(",", ":")).strip("[]")), ",").cast(f"array<{kind}>")


def _share(value: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(value, pattern, "")) / F.length(value)


def _mean(values: Column, otherwise: float) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(values) > 0, total / F.size(values)).otherwise(otherwise)


def with_features(found: DataFrame, tables: tuple[list[float], list[int]]) -> DataFrame:
    value, before = F.col("value"), F.lower("before")
    pairs, known = _numbers(tables[0], "double"), _numbers(tables[1], "int")
    # Letters as 0 to 25; whatever is no letter breaks a gram, and so do gaps.
    codes = F.transform(F.split(F.lower(value), ""), lambda c: F.ascii(c) - 97)
    letter = lambda x: (x >= 0) & (x < 26)
    of_codes = F.col("codes")

    def at(i: Column, k: int) -> Column:
        return F.get(of_codes, i + k)

    places = F.sequence(F.lit(0), F.length(value) - 3)
    two = F.filter(places, lambda i: letter(at(i, 0)) & letter(at(i, 1)))
    three = F.filter(places, lambda i: letter(at(i, 0)) & letter(at(i, 1)) & letter(at(i, 2)))
    odds = F.transform(two, lambda i: F.log(F.get(pairs, at(i, 0) * 26 + at(i, 1))))
    hit = F.transform(
        three, lambda i: F.get(known, (at(i, 0) * 26 + at(i, 1)) * 26 + at(i, 2)).cast("double")
    )
    shape = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(value, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0"
    )
    near = F.array_distinct(F.split(F.concat_ws(" ", before, F.lower(F.substring("after", 1, 16))), "[^a-z0-9]+"))
    path = F.coalesce("path", F.lit(""))
    flag = lambda c: c.cast("double")
    return (
        found.withColumn("codes", codes)
        .withColumns(
            {
                "length": F.least(F.length(value), F.lit(256)).cast("double"),
                "digits": _share(value, "[^0-9]"),
                "uppers": _share(value, "[^A-Z]"),
                "symbols": _share(value, "[A-Za-z0-9]"),
                "classes_change": F.length(shape) / F.length(value),
                "hex": flag(value.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
                "distinct": F.size(F.array_distinct("codes")) / F.length(value),
                "transition": _mean(odds, -3.0),
                "covered": _mean(hit, 0.0) * F.size(three) / F.greatest(F.size(places), F.lit(1)),
                "path_depth": F.least(F.size(F.split(path, "/")), F.lit(16)).cast("double"),
                "path_harmless": flag(path.rlike(HARMLESS_PATH)),
                "path_config": flag(path.rlike(CONFIG_PATH)),
                "secret_word": flag(F.arrays_overlap(near, F.array(*map(F.lit, SECRET_WORDS)))),
                "harmless_word": flag(F.arrays_overlap(near, F.array(*map(F.lit, HARMLESS_WORDS)))),
                "assigned": flag(before.rlike(r"[=:]\s*[\"'`]?$")),
                "quoted": flag(before.rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")),
            }
        )
        .drop("codes")
    )


def _labelled(found: DataFrame) -> DataFrame:
    """Candidates with the ``label`` that the strict rule gives them."""
    name = r"(?i)(api|auth|credential|key|passwd|password|pwd|secret|token)[a-z0-9_-]*[\"']?\s*[=:]\s*"
    value, before, after = F.col("value"), F.col("before"), F.col("after")
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= 8)
    quoted = before.rlike(name + "[\"']$") & after.rlike("^[\"']")
    bare = before.rlike(name + "$") & after.rlike(r"^([\s,;]|$)")
    return found.withColumn("label", ((quoted | bare) & mixed).cast("double"))


def drawn_findings(found: DataFrame) -> DataFrame:
    """About LABELLED different candidates of each label, from all; no label that occurs is left out."""
    marked = kept(_labelled(found).dropDuplicates(["path", "value", "before", "after"]), "labelled")
    totals = dict(marked.groupBy("label").count().collect())  # two rows
    chosen = [
        (F.col("label") == label) & drawn(fraction_for(LABELLED[label], n), "path", "value", "before", "after")
        for label, n in totals.items()
    ]
    return marked.filter(reduce(or_, chosen, F.lit(False))).drop("label")


def labelled_findings(found: DataFrame) -> DataFrame:
    """Findings with a ``label``, where a team has no labels of its own yet.

    A value of mixed or hexadecimal letters and digits, quoted or bare up to a blank, that a
    credential's name is assigned is a secret. Other candidates are not. Since real findings say
    little about what merely looks like a secret, each secret also gives findings of the kinds that
    reviewers close: the value as a checksum in prose, a placeholder of the same length, words
    joined to that length, and the same under a test path; and, as secrets, the value in other
    alphabets.
    """
    value = F.col("value")
    plain = _labelled(found)
    base64 = F.substring(F.base64(F.unhex(F.sha2(value, 256))), 1, 40)
    words = F.substring(F.repeat(F.concat(F.regexp_replace(F.lower("before"), "[^a-z]+", "_"), F.lit("_")), 3), 1, 40)
    path, before, after = (F.col(c) for c in ("path", "before", "after"))
    tests = F.concat(F.lit("tests/fixtures/"), F.coalesce("path", F.lit("")))

    def kind(label: float, value: Column, before: Column | str, after: Column | str, path: Column | str = path) -> Column:
        parts = {"value": value, "before": before, "after": after, "path": path, "label": label}
        return F.struct(*((c if isinstance(c, Column) else F.lit(c)).alias(n) for n, c in parts.items()))

    kinds = F.array(
        kind(0.0, value, " sha1 checksum ", " of the file"),
        kind(0.0, F.repeat(F.lit("x"), F.length(value)), before, after),
        kind(0.0, words, before, after),
        kind(0.0, value, ' example token = "', after, tests),
        kind(1.0, base64, " secret_key: ", ""),
        kind(1.0, base64, 'password="', '"', "config/app.env"),
    )
    made = plain.filter("label = 1").select("doc_id", "ordinal", F.explode(kinds).alias("k")).select(
        "doc_id", "k.path", "ordinal", "k.value", "k.before", "k.after", "k.label"
    )
    return plain.unionByName(made).filter(F.length("value") >= SHORTEST)


def train(findings: DataFrame, tables: tuple[list[float], list[int]]) -> PipelineModel | None:
    """The forest, from findings (value, before, after, path, label 0 or 1).

    None where no finding, or none of one of the labels, is given.
    """
    # Findings are a bounded sample, and every level of the trees is a job over them: few tasks do.
    ready = kept(with_features(findings, tables).select(*FEATURES, "label"), "findings").coalesce(4)
    totals = dict(ready.groupBy("label").count().collect())  # two rows
    if len(totals) < 2:
        return None
    # The few of a rare label come again and again, or most trees would be drawn without them.
    times = F.when(F.col("label") == 1, -(-FEWEST // totals[1.0])).otherwise(-(-FEWEST // totals[0.0]))
    ready = ready.withColumn("again", F.explode(F.sequence(F.lit(1), times)))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(numTrees=40, maxDepth=8, seed=7, minInstancesPerNode=2)
    return PipelineModel([assembler, forest.fit(assembler.transform(ready))])


def scored(found: DataFrame, tables: tuple[list[float], list[int]], model: PipelineModel | None) -> DataFrame:
    """Candidates with ``score`` and ``secret``. Without a model nothing is a secret."""
    columns = [F.col(c) for c in ("doc_id", "path", "ordinal", "value", "before", "after")]
    if model is None:
        return found.select(*columns, F.lit(0.0).alias("score"), F.lit(False).alias("secret"))
    ready = with_features(found, tables)
    score = vector_to_array("probability")[1]
    return model.transform(ready).select(*columns, score.alias("score"), (score >= 0.5).alias("secret"))


def _narrow(docs: DataFrame, path: str | None) -> DataFrame:
    return docs.select("doc_id", "text", (F.col(path) if path else F.lit(None)).cast("string").alias("path"))


def scan(docs: DataFrame, path: str | None = "source", findings: DataFrame | None = None) -> DataFrame:
    """doc_id, path, ordinal, value, before, after, score and secret of every candidate.

    ``docs`` has doc_id, text and a path column (or none); other columns are not looked at.
    ``findings`` are labelled findings; without them some are drawn by label from all documents. Null and
    empty texts have no candidates, a null path has no depth and no name, a null doc_id stays null
    and repeated rows are found repeatedly. Texts of any length are scanned whole, by patterns that Java
    matches without recursion; candidates that tie have one score.
    """
    docs = _narrow(docs, path)
    tables = dictionary(docs)
    if findings is None:
        findings = labelled_findings(drawn_findings(candidates(docs)))
    return scored(candidates(docs), tables, train(findings, tables))


def redacted(docs: DataFrame, path: str | None = "source", mark: str = "<secret>") -> DataFrame:
    """``docs`` with each secret in a text replaced by ``mark``; all columns and rows stay.

    Rows of one doc_id with different texts are told apart by the text; equal rows are treated
    alike, null ids too. Null and empty texts stay as they are; a text of any length, and with any number
    of candidates, is split once. n_chars, where it is a column, follows the text.
    """
    key, found, secrets = (unused(docs, name) for name in ("_key", "_found", "_secrets"))
    text = F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text))
    named = docs.withColumn(key, digest)
    ordinals = (
        scan(named.select(F.col(key).alias("doc_id"), "text", *([path] if path else [])), path)
        .filter("secret")
        .groupBy(F.col("doc_id").alias(found))
        .agg(F.collect_set("ordinal").alias(secrets))
    )
    values = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    # Each text is split once: the pieces are an argument of the transform, not part of what it does.
    between = F.split(text, CANDIDATE)
    pairs = F.arrays_zip(between.alias("gap"), F.concat(F.array(F.lit("")), values).alias("value"))
    shown = F.transform(
        pairs,
        lambda pair, i: F.concat(
            F.when(F.array_contains(secrets, i - 1), F.concat(_named(pair["value"]), F.lit(mark))).otherwise(pair["value"]),
            pair["gap"],
        ),
    )
    clean = F.array_join(shown, "")
    changed = F.col(secrets).isNotNull()
    out = named.join(ordinals, F.col(key) == F.col(found), "left")
    out = out.withColumn("text", F.when(changed, clean).otherwise(F.col("text")))
    return with_length(out, changed).select(*own_columns(docs))

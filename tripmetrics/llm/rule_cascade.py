"""Quality rules as a short-circuit cascade.

Every rule either rejects a text or passes it on, so the verdict does not depend on their order, but
the cost does. Each rule's seconds and rejections are measured on a drawn sample of the documents,
where the cascade would meet them: on texts that pass the base, whose base counts are there already. The
rules then run in order of rejections per second, and a text leaves at its first rejection.
"""

from __future__ import annotations

import re
import time

from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property
from typing import NamedTuple

import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import drawn, fraction_for

#: About so many documents are drawn to measure the rules on.
SAMPLE_DOCUMENTS = 2000

_SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\v\f\r"
_NO_LETTER = re.compile(r"[\W\d_]+")
_UPPER = re.compile(r"[A-Z]")
_ASCII_LETTER = re.compile(r"[A-Za-z]")


class Text:
    """A text and what the rules look at, computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode().split()  # bytes split at the six ASCII blanks only

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, _BLANKS))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, _SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(_BLANKS)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in a window of three that the text holds twice or more."""
        words = self.words
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == len(windows):
            return 0
        times = Counter(windows)
        covered = bytearray(len(words))
        for i, window in enumerate(windows):
            if times[window] > 1:
                covered[i : i + 3] = b"\1\1\1"
        return sum(covered)

    @cached_property
    def base_failed(self) -> bool:
        return self.n_words < 50 or 100 * self.n_repeat_words > 50 * self.n_words

    @property
    def counts(self) -> tuple[int, int, int, int, int, bool]:
        """The base counts, which every document's row has, and whether the base fails."""
        return self.n_words, self.word_chars, self.n_symbols, self.n_dup_lines, self.n_repeat_words, self.base_failed


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Text], bool]


def _few_letters(t: Text) -> bool:
    return 10 * len(_NO_LETTER.sub("", t.text)) < 7 * t.word_chars


def _shouting(t: Text) -> bool:
    return 2 * len(_UPPER.findall(t.text)) > len(_ASCII_LETTER.findall(t.text))


#: The rules and their bounds. Each is a plain count comparison, so SQL can say the same.
RULES = (
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("long_words", lambda t: t.word_chars > 10 * t.n_words),
    Rule("short_words", lambda t: t.word_chars < 2 * t.n_words),
    Rule("dup_lines", lambda t: 10 * t.n_dup_lines > 3 * len(t.lines)),
    Rule("exclamation", lambda t: 2 * t.text.count("!") > t.n_words),
    Rule("few_letters", _few_letters),
    Rule("shouting", _shouting),
)


def measured(docs: DataFrame, rules: tuple[Rule, ...] = RULES, bound: int = SAMPLE_DOCUMENTS) -> list[tuple[str, float, float]]:
    """(rule, seconds a text, share rejected) over a sample of about ``bound`` documents.

    Only texts that pass the base count, as no rule sees another. A rule's seconds are what it adds to
    the base counts; where no drawn text passes, every rule has nought of both.
    """

    def trial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected, n = [0.0] * len(rules), [0] * len(rules), 0
        for batch in batches:
            for value in batch.column(0):
                text = Text(value.as_py())
                if text.counts[-1]:
                    continue
                n += 1
                for k, rule in enumerate(rules):
                    start = time.perf_counter()
                    rejects = rule.rejects(text)
                    seconds[k] += time.perf_counter() - start
                    rejected[k] += bool(rejects)
        yield pa.RecordBatch.from_pydict(
            {"rule": list(range(len(rules))), "seconds": seconds, "rejected": rejected, "n": [n] * len(rules)}
        )

    share = fraction_for(bound, docs.count())
    found = (
        docs.filter(drawn(share, "doc_id"))
        .select("text")
        .mapInArrow(trial, "rule long, seconds double, rejected long, n long")
        .groupBy("rule")
        .agg(F.sum("seconds"), F.sum("rejected"), F.sum("n"))
        .collect()  # one row for each rule
    )
    return [(rules[k].name, s / max(n, 1), r / max(n, 1)) for k, s, r, n in sorted(found)]


def ordered(figures: list[tuple[str, float, float]], rules: tuple[Rule, ...] = RULES) -> list[Rule]:
    """Rules by rejections per second, highest first; a tie goes to the cheaper rule, then by name."""
    by_name = {rule.name: rule for rule in rules}
    found = sorted(figures, key=lambda f: (-f[2] / max(f[1], 1e-9), f[1], f[0]))
    return [by_name[name] for name, _, _ in found] + [
        rule for rule in rules if rule.name not in {f[0] for f in figures}
    ]


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean"
)


def judge(docs: DataFrame, cascade: list[Rule]) -> DataFrame:
    """The base counts of every row of (doc_id, text) and whether the cascade keeps it.

    A null text is empty; an empty text has no words and fails the base. A null doc_id stays null
    and repeated rows stay repeated. Other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(1):
                t = Text(value.as_py())
                counts = t.counts
                out.append((*counts, not t.base_failed and not any(rule.rejects(t) for rule in cascade)))
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
            columns = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def rule_cascade(docs: DataFrame) -> DataFrame:
    """Measure the rules on a sample, order them, and judge every document."""
    return judge(docs, ordered(measured(docs)))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), t AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), w AS (
  SELECT row_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM t
), tri AS (
  SELECT row_id, i, word AS a, lead(word) OVER p AS b, lead(word, 2) OVER p AS c
  FROM w WINDOW p AS (PARTITION BY row_id ORDER BY i)
), again AS (
  SELECT row_id, i FROM (
    SELECT row_id, i, count(*) OVER (PARTITION BY row_id, a, b, c) AS n FROM tri WHERE c IS NOT NULL
  ) WHERE n > 1
), repeated AS (
  SELECT row_id, count(DISTINCT j) AS n
  FROM (SELECT row_id, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY row_id
), base AS (
  SELECT t.row_id, doc_id, text, len(words) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words
  FROM t LEFT JOIN repeated r ON t.row_id = r.row_id
), failed AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
  AND NOT 10 * n_symbols > n_words
  AND NOT word_chars > 10 * n_words
  AND NOT word_chars < 2 * n_words
  AND NOT 10 * n_dup_lines > 3 * n_lines
  AND NOT 2 * length(regexp_replace(text, '[^!]', '', 'g')) > n_words
  AND NOT 10 * length(regexp_replace(text, '[^\p{L}]', '', 'g')) < 7 * word_chars
  AND NOT 2 * length(regexp_replace(text, '[^A-Z]', '', 'g'))
    > length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS kept
FROM failed
"""

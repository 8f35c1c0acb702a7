from __future__ import annotations

import os

from pathlib import Path

import pytest

# Python workers import the package too.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(Path(__file__).resolve().parents[2]), *filter(None, [os.environ.get("PYTHONPATH")])]
)

SF = "/root/testdata/sf0.001"
EXTRA = ("score", "bits", "key", "row", "_key", "_bits", "line_id", "a.b", "length", "path")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


EDGE_ROWS = [
    (1, "the same words in one line that is repeated\nsecond line", "en"),
    (1, "the same words in one line that is repeated\nsecond line", "en"),
    (1, "another text under the same number", "en"),
    (None, "a text without a number", None),
    (None, None, None),
    (3, None, "en"),
    (4, "", None),
    (5, " \n\t \r\n", "en"),
    (6, "word " * 30_000 + "end", "en"),
    (7, "é" * 5_000 + "\x85\x1c漢字", "fr"),
    (8, "you are a worthless idiot and a stupid clown", "en"),
    (9, "!!! ### $$$ %%%", "en"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, blanks, long texts, ties, repeated rows and columns with clashing names."""
    df = spark.createDataFrame(
        [(d, t, s, None if t is None else len(t), *["x"] * len(EXTRA)) for d, t, s in EDGE_ROWS],
        "doc_id long, text string, source string, n_chars long, "
        + ", ".join(f"`{name}` string" for name in EXTRA),
    )
    return df.cache()


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)

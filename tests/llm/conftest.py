"""Awkward tables that every operator must take."""

from __future__ import annotations

import random

import pytest

CLASHES = ("keep", "cuts", "longest_repeat", "node", "root", "band", "bands", "anchor", "at", "place", "values", "score", "posterior", "copies", "rate", "p", "n_tokens", "domains", "domain", "k0", "stratum", "failed", "half", "ids", "payload", "s0", "least", "n_words", "digits", "good", "leaves", "sections", "equal_to", "blocked", "entry", "n_main")


def words(seed: int, n: int, size: int = 5000) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def awkward_rows() -> list[tuple]:
    long = words(1, 120_000, 10**9)
    same = words(2, 300)
    rows = [
        (1, "", "en", "s", 0), (2, None, "en", "s", None), (None, words(3, 80), None, None, None), (None, None, None, None, None), (4, " \n\t ", "fr", "s", 4), (5, "y" * 300_000, "de", "s", 300_000),
        (6, long, "en", "s", len(long)), (6, long, "en", "s", len(long)), (7, same, "en", "s", len(same)), (7, same, "en", "s", len(same)), (8, same, "es", "s", len(same)), (9, "one two", "en", "s", 7),
        (9, "a different text with the same number", "en", "s", 37), (10, "é ▁ \U0001f600 \x00 日本", "xx", "s", 9), (-5, same + " tail", "en", None, None),
    ]
    return [(*r, *("clash",) * len(CLASHES)) for r in rows]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)).repartition(3)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (7, 1, 0), (7, 1, 0), (8, 0, 1), (9, 1, None), (9, 0, 0), (None, 1, 0), (6, None, None), (77, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")

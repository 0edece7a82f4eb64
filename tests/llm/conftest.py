from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, source string, size string, score string, ids string, spans string, component_id string"
WORDS = "the of and to a in that it is was for on are with as his they at be this from have or by one had not but what all".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + (rng.choice("abcdefgh") if rng.random() < 0.5 else "") for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank and very long texts, copies, near copies, repeated rows, NULL ids and sources."""
    rng = random.Random(4)
    base = sentence(rng, 120).split()
    near = lambda k: " ".join("x" if i == k else w for i, w in enumerate(base))
    texts = [None, "", " \t\n\x0b ", "one", "one two three four", sentence(rng, 20000), " ".join(base), " ".join(base).upper(),
             near(3), near(60), sentence(rng, 40), sentence(rng, 300), "same words\n" * 30, "é ñ 日本 \x1c x\u00a0y"]
    rows = [(i, t, ["s1", "s2", None, "s3"][i % 4], "9", "z", "q", "r", "7") for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, sentence(rng, 50), "s1", None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)

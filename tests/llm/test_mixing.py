from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from incidentlens.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    goal, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        level = (goal - sum(target.values())) / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * level >= cap * sizes[s]}
        if not over:
            return target | {s: w[s] * level for s in open_}
        target |= {s: cap * sizes[s] for s in over}
        open_ -= over
    return target


def check(df):
    rows = mixing.mix(df).collect()
    sizes: dict = {}
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    target, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["times"] * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        largest = max(r["size"] for r in rows if r["source"] == s)
        assert abs(taken[s] - target[s]) <= largest / 2 + 1e-6, s
    return sorted((r["doc_id"] is None, r["doc_id"], r["taken"]) for r in rows)


def test_targets_and_taken_words(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "a", "a", "b", "ä", "z", "Z", None])) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert check(df) == check(df.repartition(5))


def test_odd_rows(odd, none):
    check(odd)
    assert mixing.mix(none).count() == 0
    mixed = mixing.mix(odd)
    assert mixing.repeated(mixed).count() == mixed.agg(F.sum("times")).first()[0]


def test_order_of_sources_is_by_code_point(spark):
    src = spark.createDataFrame([("b",), ("B",), (None,), ("ä",), ("",)], "source string")
    got = {r["source"]: r["position"] for r in mixing.source_order(src).collect()}
    assert got == {"": 0, "B": 1, "b": 2, "ä": 3, None: 4}

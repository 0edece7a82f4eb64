"""Phrase mining against counting every phrase in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from incidentlens.llm import phrases

COLS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, min_count=100, longest=5, first=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, count in f.items():
        often = {p: a for p, a in count.items() if a >= min_count}
        inside = set()
        for q, b in often.items():
            for k in range(2, len(q)):
                inside |= {q[i:i + k] for i in range(len(q) - k + 1) if 100 * b >= 100 * often[q[i:i + k]]}
        found = []
        for p, a in often.items():
            if len(p) > 1 and p not in inside:
                score, _, l, r = min((1000 * a * n[lang] // (often[p[:k]] * often[p[k:]]), k, often[p[:k]], often[p[k:]])
                                     for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p), l, r))
        found.sort(key=lambda x: (x[0], x[1], x[2].encode()))
        out += [(lang, i, x[2], -x[1], x[3], x[4], n[lang], -x[0]) for i, x in enumerate(found[:first], 1)]
    return sorted(out)


def random_rows(seed=0, n=300):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["É", "日本", "a b", "\x1e", "\x1c", "A", "a"]
    fixed = ["w1 W2 w3", "w4 w5", "w4 w5 w6 w7 w8 w9", "a a a a a a a"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words[: rng.choice([5, 47])]) for _ in range(rng.randint(0, 120))]
        text = "".join(p + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "!? "]) for p in parts)
        rows.append((text, rng.choice(["en", "en", "en", "de", None, "und"])))
    return rows


def found(spark, rows, **kw):
    df = phrases.collocations(spark.createDataFrame(rows, "text string, lang string").repartition(4), **kw)
    assert df.columns == COLS
    got = sorted(tuple(r) for r in df.collect())
    assert got == brute(rows, **kw)
    return got


def test_equals_counting(spark):
    assert found(spark, random_rows(), min_count=20)


@pytest.mark.parametrize("ranks", [0, 3, 30])
def test_words_and_phrases_beyond_the_ranks(spark, monkeypatch, ranks):
    monkeypatch.setattr(phrases, "RANKS", max(1, ranks))
    monkeypatch.setattr(phrases, "TAIL_BITS", 1 << 15 if ranks else 1 << 18)
    monkeypatch.setattr(phrases, "HELD_PAIRS", 1000)
    assert found(spark, random_rows(1), min_count=15, first=40)


def test_tiles_equal_plain_counts(monkeypatch):
    monkeypatch.setattr(phrases, "DENSE", 50)
    rng = np.random.default_rng(1)
    top = phrases.RANKS
    left = np.concatenate([rng.integers(1, 40, 5000), rng.integers(1, top + 1, 500), [top, 2**62 + 5, 2**62 + 5, 7, 3]])
    right = np.concatenate([rng.integers(2040, 2060, 5000), rng.integers(1, top + 1, 500), [top, 9, 9, 2**62 + 1, 3]])
    l, r, n = phrases.count_pairs(left, right)
    got = dict(zip(zip(l.tolist(), r.tolist()), n.tolist()))
    assert len(got) == len(l) and got == Counter(zip(left.tolist(), right.tolist()))


def test_odd_texts(spark, none):
    rows = [(None, "en"), ("", None), (" \t\n.,", "en"), ("one", "en"), ("x y " * 200_000, "en"), ("same line\n" * 300, None),
            ("same line\n" * 300, None), ("z" * 100_000 + " q ", "de")] + [("z" * 1000 + " q ", "de")] * 130
    got = found(spark, rows)
    assert {r[0] for r in got} == {"en", "und", "de"}
    found(spark, [("a b c", "en")] * 99)
    assert phrases.collocations(none.withColumnRenamed("source", "lang")).count() == 0


def test_large_products(spark):
    """Products beyond 64 bits."""
    df = spark.sql("select 4e15 a, 8e15 n, 4e15 l, 5e15 r").selectExpr(*[f"cast({c} as long) {c}" for c in "anlr"])
    got = df.selectExpr(phrases.SCORE).first()[0]
    assert got == 1000 * 4 * 10**15 * 8 * 10**15 // (4 * 10**15 * 5 * 10**15)

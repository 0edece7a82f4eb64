"""Spelling variants against a brute force over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from incidentlens.llm import variants
from incidentlens.llm.common import table

COLS = ["word", "form", "root", "n", "n_near", "form_n"]


def brute_counts(rows, min_length=6, min_count=5):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= min_length and k >= min_count}


def is_near(x, y):
    if len(x) > len(y):
        x, y = y, x
    if x == y or len(y) - len(x) > 1:
        return False
    d = next((k for k in range(len(x)) if x[k] != y[k]), len(x))
    return x[d + (len(x) == len(y)):] == y[d + 1:]


def brute_variants(n):
    by = {}
    for w in n:  # words that are near agree in one half, so only words with one beginning or end are compared
        for part in {("a", w[:3]), ("b", w[-3:])}:
            by.setdefault(part, []).append(w)
    near = {w: set() for w in n}
    for own in by.values():
        for k, x in enumerate(own):
            for y in own[k + 1:]:
                if is_near(x, y):
                    near[x].add(y)
                    near[y].add(x)
    form = {}
    for w, other in near.items():
        best = min(other, key=lambda y: (-n[y], y), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def rows_of(df):
    assert df.columns == COLS
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    n = brute_counts(docs)
    got = rows_of(variants.op12_spelling_variants(spark, sf))
    assert got == brute_variants(n) and any(r[1] for r in got)


@pytest.mark.parametrize("most", [variants.MOST, 40, 3])
def test_dense_vocabulary_in_groups_of_any_size(spark, most):
    """Few letters, so most words are near others; small limits divide the windows down to one place."""
    rng = random.Random(5)
    n = {}
    while len(n) < 700:
        w = "".join(rng.choice("ab") for _ in range(rng.randint(6, 10)))
        n[w] = rng.choice([5, 6, 30, 31, 200, 1500, 9000])
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert rows_of(variants.variants(df, most=most)) == brute_variants(n)


def test_chains_of_forms(spark):
    words = ["abcdefgh", "abcdefg", "abcdef", "xabcdef", "xyabcdef", "xyzabcdef"]
    n = {w: 5 ** (k + 1) for k, w in enumerate(words)}
    got = {r[0]: r for r in rows_of(variants.variants(spark.createDataFrame(list(n.items()), "word string, n long")))}
    assert {r[2] for r in got.values()} == {"xyzabcdef"} and set(got.values()) == brute_variants(n)


def test_machine_equals_brute_force():
    rng = random.Random(2)
    for size in (1, 2, 5, 40, 150):
        words = {"".join(rng.choice("abc") for _ in range(rng.randint(0, 5))) for _ in range(size)}
        want = {frozenset((x, y)) for x in words for y in words if is_near(x, y)}
        got = variants.near_pairs(list(words), 9)
        assert len(got) == len(want) and {frozenset(p) for p in got} == want


def test_long_words(spark):
    rng = random.Random(3)
    long_ = "".join(rng.choice("abcde") for _ in range(20_001))
    words = {long_, "z" + long_[1:], long_[:-1], long_[:9000] + long_[9001:], "a" * 20_000, "a" * 20_001, "a" * 19_999 + "b"}
    n = {w: 5 ** (k + 1) for k, w in enumerate(sorted(words))}
    assert rows_of(variants.variants(spark.createDataFrame(list(n.items()), "word string, n long"))) == brute_variants(n)


def test_checksums_of_joined_texts():
    rng = random.Random(1)
    pairs = [(rng.randbytes(rng.randint(0, 20)), rng.randbytes(rng.randint(0, 90))) for _ in range(300)]
    got = variants.Checksums(4).joined(np.array([zlib.crc32(a) for a, _ in pairs], np.uint32),
                                       np.array([zlib.crc32(b) for _, b in pairs], np.uint32), [len(b) for _, b in pairs])
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_odd_texts(spark, odd, odd_rows, none):
    rng = random.Random(8)
    texts = [None, "", "a" * 300_000, "Ünïcode×ÿes " * 40, "straße-straßen STRASSE " * 30, "Ābcdefg naïve " * 9,
             " ".join(rng.choice(["colour", "color", "colors", "Kolour", "honour", "honor"]) for _ in range(30000))]
    rows = [(None if k == 3 else k, t) for k, t in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(variants.variants(variants.word_counts(df))) == brute_variants(brute_counts(rows))
    both = [(r[0], r[1]) for r in odd_rows]
    assert rows_of(variants.variants(variants.word_counts(odd))) == brute_variants(brute_counts(both))
    assert variants.variants(variants.word_counts(none)).count() == 0

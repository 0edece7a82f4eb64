from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from incidentlens.llm import quality

from .conftest import sentence

WORD = r"[^\x20\x09-\x0D]+"


def base(text):
    t = text or ""
    w = re.findall(WORD, t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
    n, covered = Counter(windows), set()
    for k, x in enumerate(windows):
        if n[x] > 1:
            covered.update(range(k, k + 8))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_base_columns_equal_brute_force(spark, odd):
    rng = random.Random(2)
    block = sentence(rng, 12)
    texts = [block + " " + sentence(rng, 30) + " " + block, (block + "\n") * 4, "a b c d e f g h a b c d e f g h",
             "x\f\x0by\rz | # $ <b>", "\n\n a \n a \nb\n a ", "f f fine form feed", *[sentence(rng, k) for k in (7, 8, 9, 40)]]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    got = quality.quality_rules(docs, labels(spark, [])).collect()
    want = Counter((r[0], *base(r[1])) for r in docs.collect())
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[c] for c in cols) for r in got) == want
    assert all(r["kept"] == (not r["base_failed"]) for r in got)  # no labels: only the base rules decide


def test_scores_follow_the_two_multinomials_and_junk_goes(spark):
    rng = random.Random(3)
    good = [(i, sentence(rng, 80)) for i in range(120)]
    junk = [(200 + i, " ".join(w + rng.choice(["!!", "***"]) for w in sentence(rng, 80).upper().split())) for i in range(60)]
    docs = spark.createDataFrame(good + junk + [(999, None)], "doc_id long, text string")
    marks = labels(spark, [(i, 1, 0) for i in range(0, 120, 2)] + [(200 + i, 0, 0) for i in range(0, 60, 2)] + [(1, 1, 1), (None, 1, 0)])
    judged = {r["doc_id"]: r for r in quality.quality_rules(docs, marks).collect()}
    assert all(judged[i]["kept"] for i, _ in good) and not any(judged[i]["kept"] for i, _ in junk)
    assert judged[999]["kept"] is False and judged[999]["score"] is None
    # the score is the mean log ratio over single words and pairs, as cells of the two tables
    sample = quality.labelled_sample(marks)
    ratios = quality.log_ratios(docs, sample)
    cells = quality.with_words(docs.where("doc_id = 5")).select(quality.ngram_cells().alias("c")).first()["c"]
    assert len(cells) == 80 + 79
    assert abs(np.round(ratios, 4)[cells].mean() - judged[5]["score"]) < 1e-9


def test_empty_table(spark, none):
    assert quality.quality_rules(none, labels(spark, [(1, 1, 0), (2, 0, 0)])).count() == 0


def test_threshold_keeps_the_good():
    assert quality.fit_threshold([(0.5, True), (0.6, True), (-1.0, False)]) == -0.25
    assert quality.fit_threshold([(0.5, True)]) == -np.inf

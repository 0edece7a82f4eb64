"""Exact deduplication against a plain grouping, with filters of any fill."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from incidentlens.llm import copies

OUT = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    """Counter of (doc_id, keep_id, group_size, sha) and, by text, how many rows stay."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        sha = hashlib.sha256(text.encode()).hexdigest()
        for i in ids:
            out[i, max(known) if known else None, len(ids), sha] += 1
    return out


def check(df):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = copies.exact_copies(df)
    assert got.columns == OUT
    got = got.collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == brute(rows)
    stay = Counter(r["text_sha256"] for r in got if r["kept"])
    assert stay == Counter({sha: 1 for _, _, _, sha in brute(rows)})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    left = copies.without_copies(df)
    assert left.columns == df.columns
    left = Counter((r["doc_id"], hashlib.sha256(lower(r["text"]).encode()).hexdigest()) for r in left.collect())
    assert left == Counter({(keep, sha): 1 for _, keep, _, sha in brute(rows)})


def random_rows(n=3000):
    rng = random.Random(13)
    rows = [(i, rng.choice("aAbBéÉ") * rng.randint(0, 60) + str(rng.randint(0, 900))) for i in range(n)]
    rows += [(n + i, rng.choice(["Hot Text", "hot text"])) for i in range(n // 2)]  # a third of all rows
    rng.shuffle(rows)
    return rows


def test_equals_grouping(spark):
    check(spark.createDataFrame(random_rows(), "doc_id long, text string").repartition(5))


@pytest.mark.parametrize("most", [64, 1 << 12])
def test_a_full_filter_changes_nothing(spark, monkeypatch, most):
    monkeypatch.setattr(copies, "MIN_BITS", 64)
    monkeypatch.setattr(copies, "MAX_BITS", most)
    monkeypatch.setattr(copies, "HOT_SHARE", 8)  # the large group by broadcast, all others by shuffle
    check(spark.createDataFrame(random_rows(600), "doc_id long, text string").repartition(5))


def test_single_rows_pass_without_a_shuffle(spark):
    rows = [(i, f"text {i}") for i in range(20000)] + [(20000, "text 7")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", copies.text_digest("text"))
    bits = copies.filter_bits(len(rows))
    told = copies.with_verdict(df, "key", bits, copies.repeat_filter(df, "key", bits))
    maybe = {r["doc_id"] for r in told.where("_maybe").collect()}
    assert {7, 20000} <= maybe and len(maybe) < 400


def test_odd_rows(odd, none):
    check(odd)
    assert copies.exact_copies(none).count() == 0 and copies.without_copies(none).count() == 0
    clash = odd.withColumnRenamed("size", "keep_id").withColumnRenamed("score", "kept").withColumnRenamed("ids", "_row")
    check(clash.select("doc_id", "text", "source"))
    assert copies.exact_copies(clash).columns == OUT
    assert set(copies.without_copies(clash).columns) == set(clash.columns)

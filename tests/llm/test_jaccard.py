from __future__ import annotations

import random

import numpy as np
import pytest

from incidentlens.llm import jaccard

from .conftest import sentence


def brute(rows):
    """(n_shingles, component) per row, by all pairs."""
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b in range(a):
            j = rows[b][0]
            if i is None or j is None or not sets[a] or not sets[b]:
                continue
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i is None, i or 0), len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets))


def result(df):
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_shingles"], r["component_id"])
                  for r in jaccard.near_duplicates(df).collect())


def test_drifting_copies_and_shared_passages(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(6):  # every copy a little farther from the first: linked only through each other
        words = sentence(rng, 90).split()
        for _ in range(12):
            words[rng.randrange(len(words))] = sentence(rng, 1)
            rows.append((len(rows), " ".join(words)))
    passage = sentence(rng, 60)
    rows += [(len(rows) + k, passage + " " + sentence(rng, 40)) for k in range(15)]
    rows += [(500 + k, sentence(rng, rng.randint(1, 30))) for k in range(40)] + [(600, "Same Words here"), (601, "same words HERE")]
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


def test_odd_rows(odd, odd_rows, none):
    assert result(odd) == brute([(r[0], r[1]) for r in odd_rows])
    assert jaccard.near_duplicates(none).count() == 0
    kept = jaccard.without_near_copies(odd)
    assert kept.columns == odd.columns
    heads = {c for (null, i), _, c in brute([(r[0], r[1]) for r in odd_rows]) if not null}
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted(heads)
    assert kept.where("doc_id is null").count() == 1


def test_a_group_in_parts_loses_no_link(spark, monkeypatch):
    """Groups larger than a part: every set still meets a hub."""
    import functools

    small = functools.partial(jaccard._groups.__wrapped__ if hasattr(jaccard._groups, "__wrapped__") else jaccard._groups, limit=3)
    monkeypatch.setattr(jaccard, "_groups", small)
    rng = random.Random(9)
    words = sentence(rng, 100).split()
    rows = [(k, " ".join(words[:95] + [f"z{k}"] + words[95:])) for k in range(30)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


@pytest.mark.parametrize("per_block,small", [(4, 3), (2048, 3), (4, 20), (2048, 32)])
def test_a_family_below_the_threshold(spark, monkeypatch, per_block, small):
    """Sets that share 50 to 74 %, which no hub links, with some pairs that do; in blocks of four sets, too."""
    monkeypatch.setattr(jaccard, "PER_BLOCK", per_block)
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "MAX_ROUNDS", 1)
    rng = random.Random(3)
    passage = sentence(rng, 50)
    rows = [(k, sentence(rng, 10 + k % 9) + " " + passage) for k in range(60)]
    rows += [(100 + k, rows[3 * k][1] + f" end{k}") for k in range(12)]
    rng.shuffle(rows)
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)


def test_every_linking_pair_of_a_cell_is_joined():
    rng = np.random.default_rng(4)
    for n in (2, 5, 60):
        base = rng.integers(0, 1 << 60, 40).astype(np.uint64)
        sets = [np.unique(np.concatenate([base[: rng.integers(20, 41)], rng.integers(0, 1 << 60, 3).astype(np.uint64)])) for _ in range(n)]
        comp = np.arange(n) // 2
        a, b = np.arange(0, n // 2 + 1), np.arange(n // 2, n)
        x, y = jaccard.linked_pairs(sets, a, b, comp, width=16)
        want = {(p, q) for p in a for q in b if comp[p] != comp[q]
                and 100 * len(np.intersect1d(sets[p], sets[q])) >= 75 * len(np.union1d(sets[p], sets[q]))}
        assert set(zip(x.tolist(), y.tolist())) == want and len(x) == len(want)
        keep = jaccard._forest(comp[x], comp[y])
        assert len(keep) <= n - 1


def test_no_text_is_lost_for_a_repeated_id(spark):
    rng = random.Random(5)
    one, two, three = sentence(rng, 50), sentence(rng, 60), sentence(rng, 70)
    rows = [(1, one), (1, two), (2, three), (2, two + " x"), (3, one), (3, ""), (1, one), (4, ""), (4, None)]
    kept = jaccard.without_near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((r["doc_id"], r["text"] or "") for r in kept.collect())
    assert got == sorted([(1, one), (1, two), (2, three), (3, ""), (4, "")])


def test_components_that_have_not_settled_raise(spark):
    path = spark.createDataFrame([(k, k + 1) for k in range(20)], "a long, b long")
    with pytest.raises(RuntimeError, match="settled"):
        jaccard.components(path, max_steps=1)
    assert {r["component"] for r in jaccard.components(path).collect()} == {0}


def test_hubs_are_checked_on_texts_not_on_sets(spark, monkeypatch):
    def sent(*_):
        raise AssertionError("sets of shingles are sent to their hubs")

    monkeypatch.setattr(jaccard, "set_items", sent)
    rng = random.Random(11)
    words = sentence(rng, 80).split()
    near, far = " ".join([*words[:-1], "x"]), sentence(rng, 80)
    # row 2 repeats with another text, which is not the set asked for
    docs = spark.createDataFrame([(1, " ".join(words)), (2, far), (2, near), (3, far + " y"), (4, None)], "doc_id long, text string")
    sigs = jaccard.signatures(docs, jaccard.frequency_sketch(docs))
    of = {(r["doc_id"], r["n_shingles"], r["key"]): r["lo"] for r in sigs.collect()}
    keys = {r["text"]: r["key"] for r in docs.select("text", jaccard.text_key().alias("key")).collect()}
    a, b, c = of[1, 76, keys[" ".join(words)]], of[2, 76, keys[near]], of[3, 77, keys[far + " y"]]
    classes = spark.createDataFrame([(a, 1), (b, 2), (c, 3)], "lo long, doc long")
    pairs = spark.createDataFrame([(b, a), (c, a)], "x long, hub long")
    assert [tuple(r) for r in jaccard.verified(docs, pairs, classes).collect()] == [(b, a)]


def test_parities_rule_out_no_link():
    rng = np.random.default_rng(8)
    sets = []
    for n in (1, 5, 40, 70, 300, 300, 390, 600):
        base = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        sets += [base, np.unique(np.concatenate([base[n // 20:], rng.integers(0, 1 << 62, 1 + n // 20).astype(np.uint64)])), base[n // 5:]]
    found = [jaccard.parity(s) for s in sets]
    every = np.arange(len(sets))
    gaps = jaccard._gaps(found, every, every)
    for x, p in enumerate(sets):
        for y, q in enumerate(sets):
            differ = len(np.setxor1d(p, q))
            assert jaccard.parity_gap(found[x], found[y]) <= differ
            small, large = sorted((len(found[x]), len(found[y])))
            assert gaps[x, y] == (jaccard.parity_gap(found[x], found[y]) if large <= 2 * small else 0)
    # two strangers of 300 shingles are told apart
    assert jaccard.parity_gap(found[12], found[15]) > 600 - 2 * jaccard._needed(300, 300)


def test_no_text_is_sent_for_pairs_that_are_far_apart(spark, monkeypatch):
    """A family that shares 63 %, with some near copies: of its pairs, hardly any but the links are checked on texts."""
    sent, check = [], jaccard.verified

    def watched(docs, pairs, classes):
        doc = lambda c: classes.select(jaccard.F.col("lo").alias(c), jaccard.F.col("doc").alias(f"{c}_doc"))
        sent.extend((r["x_doc"], r["hub_doc"]) for r in pairs.join(doc("x"), "x").join(doc("hub"), "hub").collect())
        return check(docs, pairs, classes)

    monkeypatch.setattr(jaccard, "verified", watched)
    rng = random.Random(21)
    passage = sentence(rng, 230)
    rows = [(k, " ".join(f"w{rng.randrange(10**9)}" for _ in range(65)) + " " + passage) for k in range(24)]
    rows += [(100 + k, rows[5 * k][1] + f" end{k}") for k in range(4)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)) == brute(rows)
    far = [p for p in sent if max(p) - 100 != min(p) / 5]
    assert len(sent) >= 4 and len(far) <= 4

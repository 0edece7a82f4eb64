from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from incidentlens.llm import repeats

from .conftest import sentence


def long_sentence(rng, n):
    return " ".join(f"{rng.choice('abcdefghijklmnop')}{rng.randint(0, 3000)}" for _ in range(n))


def sets_of(docs, met):
    at = met.select("digest", "doc", "w0").union(met.select("hub_digest", "hub_doc", "hub_w0"))
    return repeats.line_sets(docs, at.dropDuplicates(["digest"]))


def test_passages_are_found_and_clean_documents_left_alone(spark):
    rng = random.Random(5)
    passage = long_sentence(rng, 60)
    rows = [(k, f"{long_sentence(rng, 80)} {passage} {long_sentence(rng, 70)}") for k in range(4)]  # inside a line
    rows += [(10, passage + "\n" + long_sentence(rng, 90)), (11, long_sentence(rng, 200))]
    edited = passage.split()
    edited[30] = "edited"
    rows += [(20 + k, "\n".join(long_sentence(rng, 60) for _ in range(3))) for k in range(10)]
    common = long_sentence(rng, 12)
    rows += [(40 + k, long_sentence(rng, 100) + "\n" + common) for k in range(20)]  # a short common line
    rows += [(80, long_sentence(rng, 30) + "\n" + " ".join(edited)), (90, None), (91, ""), (92, " \n "), (11, rows[5][1])]
    got = repeats.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    found = {r["doc_id"] for r in got}
    assert {0, 1, 2, 3, 10, 80} <= found
    assert not found & {20, 21, 25, 40, 41, 59, 90, 91, 92}
    assert {r["doc_id"] for r in got if r["removed"]} >= {1, 2, 3, 10}
    for r in got:
        assert 0 <= r["run_start"] <= r["word_start"] < r["word_end"] <= r["run_end"]
        if r["removed"] and r["doc_id"] in (1, 2, 3):
            assert r["kept_doc"] == 0


def test_near_lines_are_verified(spark):
    rng = random.Random(6)
    line = long_sentence(rng, 80).split()
    near, far = list(line), list(line)
    near[40] = "changed"
    for k in range(0, 80, 9):
        far[k] = f"far{k}"
    rows = [(1, " ".join(line)), (2, " ".join(near)), (3, " ".join(far)), (4, long_sentence(rng, 80))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    met = repeats.collisions(repeats.paragraph_bands(docs)).where("digest is not null")
    assert repeats.verified_lines(met, sets_of(docs, met)).count() == 1
    assert {r["doc_id"] for r in repeats.repeated_passages(docs).collect()} >= {1, 2}


def test_bands_meet_the_recall_asked_for():
    assert 1 - (1 - 0.75 ** repeats.ROWS) ** repeats.BANDS >= repeats.RECALL


def test_empty_table(none, odd):
    assert repeats.repeated_passages(none).count() == 0
    assert {6, 7, 8, 9} <= {r["doc_id"] for r in repeats.repeated_passages(odd).collect()}


def test_every_passage_of_over_50_words_is_found_inside_lines_and_however_wrapped(spark):
    """Segment borders near a passage's ends differ; before, about two of five such pairs were lost."""
    rng = random.Random(8)
    rows, places = [], {}
    for k in range(0, 80, 2):
        passage = long_sentence(rng, 51)
        first, second = rng.randint(20, 90), rng.randint(20, 90)
        rows.append((k, f"{long_sentence(rng, first)} {passage} {long_sentence(rng, 40)}"))
        if k % 4:  # wrapped at another column
            words = passage.split()
            passage = "\n".join(" ".join(words[i:i + 7]) for i in range(0, 51, 7))
        rows.append((k + 1, f"{long_sentence(rng, second)} {passage} {long_sentence(rng, 40)}"))
        places[k + 1] = second
    rows += [(200, "same " * 60), (201, "same " * 70), (300, long_sentence(rng, 400))]
    got = repeats.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"] for r in got} == set(range(80)) | {200, 201}
    for k, at in places.items():
        assert any(r["removed"] and r["kept_doc"] == k - 1 and r["word_start"] <= at and r["word_end"] >= at + 51
                   for r in got if r["doc_id"] == k)


@pytest.mark.parametrize("per_anchor", [repeats.PER_ANCHOR, 20, 0])
def test_shared_runs_equal_brute_force(spark, monkeypatch, per_anchor):
    monkeypatch.setattr(repeats, "PER_ANCHOR", per_anchor)  # anchors as one group each, some, or all as single runs
    rng = random.Random(12)
    pool = [f"w{k}" for k in range(40)]
    passages = [[rng.choice(pool) for _ in range(rng.randint(45, 120))] for _ in range(6)]
    rows = []
    for k in range(30):
        words = [rng.choice(pool) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            a = rng.randint(0, 20)
            words += p[a:] + [rng.choice(pool) for _ in range(rng.randint(0, 30))]
        rows.append((k, " ".join(words)))
    rows += [(30, "same " * 80), (31, "same " * 60 + "other"), (32, "only here " * 50)]
    first, docs_of = {}, {}
    for k, text in rows:
        w = text.split()
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i:i + 50]), (k, i))
            docs_of.setdefault(tuple(w[i:i + 50]), set()).add(k)
    want = {(k, i): first[g] for k, text in rows for i, g in
            enumerate(tuple(text.split()[i:i + 50]) for i in range(len(text.split()) - 49)) if len(docs_of[g]) > 1}
    got = {}
    for r in repeats.shared_runs(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect():
        for i in range(r["w0"], r["w1"] - 49):
            got[r["doc"], i] = (r["head"]["doc"], r["head"]["w0"] + i - r["w0"])
    assert got == want and want


def test_similar_lines_behind_an_earlier_line_are_linked(spark, monkeypatch):
    """In every bucket an earlier line, similar to neither, is the hub; and keys in several blocks."""
    rng = random.Random(14)
    base = long_sentence(rng, 60).split()
    rows = []
    for k in range(12):  # pairs that share half of a template with all others
        own = base[:35] + long_sentence(rng, 25).split()
        near = list(own)
        near[50] = "changed"
        rows += [(2 * k, " ".join(own)), (2 * k + 1, " ".join(near))]
    docs = spark.createDataFrame([(100, " ".join(base))] + [(d + 101, t) for d, t in rows], "doc_id long, text string")
    digest = {}
    for d, text in docs.collect():
        x = repeats.Lines(repeats.pa.array([text]))
        digest[d] = int(x.digests(x.starts)[0])
    met = spark.createDataFrame([(7, d + 101, 0, 60, digest[d + 101], digest[100], 100, 0, 60) for d, _ in rows],
                                "key long, doc long, w0 int, w1 int, digest long, hub_digest long, hub_doc long, hub_w0 int, hub_w1 int")
    assert repeats.verified_lines(met, sets_of(docs, met)).count() == 0
    monkeypatch.setattr(repeats, "MAX_ROUNDS", 1)  # one hub cannot link twelve pairs
    monkeypatch.setattr(repeats, "PER_BLOCK", 4)
    parts = {}
    for r in repeats.similar_lines(docs, met).collect():
        parts.setdefault(r["component"], set()).add(r["id"])
    assert sorted(map(sorted, parts.values())) == sorted(sorted({digest[101 + 2 * k], digest[102 + 2 * k]}) for k in range(12))


def test_edited_passages_are_found_however_wrapped(spark):
    """Three words of 120 differ, so no shared run has 50 words; once on one line, else wrapped at 12 and at 15 words."""
    rng = random.Random(21)
    wrapped = lambda w, n: "\n".join(" ".join(w[i:i + n]) for i in range(0, len(w), n))
    rows = []
    for k in range(0, 60, 3):
        words = long_sentence(rng, 120).split()
        for d, (columns, between) in enumerate([(12, "\n\n"), (15, "\n"), (120, "\n")]):
            own = list(words)
            for at in (30, 60, 90):
                own[at] = f"edit{d}{at}"
            rows.append((k + d, long_sentence(rng, 40) + between + wrapped(own, columns) + between + long_sentence(rng, 40)))
    rows += [(100 + k, "\n".join(long_sentence(rng, 12) for _ in range(10))) for k in range(5)]
    got = {}
    for r in repeats.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert set(got) == set(range(60))
    for doc, found in got.items():
        assert any(r["word_start"] == 40 and r["word_end"] == 160 and r["kept_doc"] == doc - doc % 3 and r["removed"] == (doc % 3 > 0)
                   for r in found)


def test_short_lines_join_up_to_a_blank_or_long_one():
    words = lambda n: " ".join(["w"] * n)
    texts = ["\n".join([words(5), words(19), words(20), words(3), "", words(4), "  ", words(6), words(1)]), words(2), words(3) + "\n"]
    x = repeats.Lines(repeats.pa.array(texts))
    assert list(x.ends - x.starts) == [24, 20, 3, 4, 7, 2, 3]


def test_anchors_are_found_without_hashing_the_runs(monkeypatch):
    """The pass that looks for shared anchors needs no hash of the runs; before, it made one of every place."""
    sizes, real = [], repeats._span_hash
    monkeypatch.setattr(repeats, "_span_hash", lambda h, size: (sizes.append(size), real(h, size))[1])
    x = repeats.Lines(pa.array([" ".join(f"w{k * k % 37}" for k in range(120)), None, "few words"]))
    at, size, key = x.runs()
    assert sizes == [repeats.ANCHOR] and size.sum() == 120 - repeats.EXACT + 1 and len(at) == len(size) == len(key)
    assert len(x.run_hashes()) == 122 and sizes == [repeats.ANCHOR, repeats.EXACT]


def test_pairs_are_told_apart():
    rng = np.random.default_rng(6)
    for n in (0, 1, 500):
        a, b = rng.integers(0, 9, n), rng.integers(-5, 5, n) * (1 << 58)
        code = repeats.pair_codes(a, b).tolist()
        pairs = list(zip(a.tolist(), b.tolist()))
        assert len(set(zip(code, pairs))) == len(set(pairs)) == len(set(code))
        assert sorted(set(code)) == list(range(len(set(code))))

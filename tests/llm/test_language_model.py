from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from incidentlens.llm import language_model as lm
from incidentlens.llm.common import Words


def small_model(dtype=np.float32):
    m = lm.Model([(f"w{i}", 100 - i % 50) for i in range(100)], np.ones(lm.ENDINGS * lm.MARKS) * 20, 10)
    m.theta = m.theta.astype(dtype)
    return m


def test_gradient_is_that_of_the_loss():
    m, rng = small_model(np.float64), np.random.default_rng(0)
    theta = m.theta + rng.normal(0, 0.1, len(m.theta))
    c_in, c_out = rng.integers(0, lm.N_CLASSES, (2, 6, 3))
    place = np.where(c_out < lm.N_HEAD, rng.integers(0, lm.PER_CLASS, (6, 3)), -1)
    first, h0 = rng.random((6, 3)) < 0.2, rng.normal(0, 0.3, (3, lm.HIDDEN))
    c_out[5, 1] = -1
    _, grad, _ = lm.loss_and_gradient(m, theta, c_in, c_out, place, first, h0)
    for i in rng.choice(np.flatnonzero(grad), 25):
        step = np.zeros_like(theta)
        step[i] = 1e-5
        up, down = (lm.loss_and_gradient(m, theta + s, c_in, c_out, place, first, h0)[0] for s in (step, -step))
        assert abs((up - down) / 2e-5 - grad[i]) < 1e-6


def test_windows_carry_the_state():
    m = small_model()
    words = Words(pa.array(["w1 w2 w3 " * 50, "w5", "", "zz w7 " * 80]))
    c, p, n = lm.sequences(m, words)
    whole = lm.score_tokens(m, c, p, n)
    ends = np.cumsum(n)
    for s, e in zip(ends - n, ends):  # each document alone gets the same
        alone = lm.score_tokens(m, c[s:e], p[s:e], np.array([e - s]))
        assert np.allclose(alone, whole[s:e], atol=1e-4)


def test_scores_equal_a_plain_recurrence_whatever_the_weights():
    """Logits that cannot overflow are not shifted before exp; those that can still are."""
    for scale, safe in ((1.0, True), (60.0, False)):
        m, rng = small_model(), np.random.default_rng(8)
        m.theta = (m.theta + rng.normal(0, 0.3, len(m.theta)) * scale).astype(np.float32)
        wx, u, wc, bc, ww, bw = (x.astype(float) for x in m.parts(m.theta))
        assert (lm.bounded(wc, bc) and lm.bounded(ww, bw)) == safe
        c, p, n = lm.sequences(m, Words(pa.array(["w1 w40 zz, w3 ab", "", "w9 " * 70])))
        want, at = [], 0
        for size in n:
            h, before = np.zeros(lm.HIDDEN), lm.END_CLASS if at == 0 else c[at - 1]
            for k in range(at, at + size):
                b, x = h @ u, wx[before]
                z, r = (1 / (1 + np.exp(-(x + b)[i * lm.HIDDEN:(i + 1) * lm.HIDDEN])) for i in range(2))
                new = np.tanh(x[2 * lm.HIDDEN:] + r * b[2 * lm.HIDDEN:])
                h = new + z * (h - new)
                logs = lambda v: v - v.max() - np.log(np.exp(v - v.max()).sum())
                value = np.log(np.exp(logs(h @ wc + bc)[c[k]]) + lm.TINY)
                if p[k] >= 0:
                    value += np.log(np.exp(logs(h @ ww[c[k]] + bw[c[k]])[p[k]]) + lm.TINY)
                want.append(value)
                before = c[k]
            at += size
        got = lm.score_tokens(m, c, p, n)
        assert np.isfinite(got).all() and np.allclose(got, want, rtol=1e-3, atol=1e-3 * scale)


def test_training_stream_has_every_token_once_in_full_windows():
    rng = np.random.default_rng(5)
    for lengths in ([1], [5, 1, 700], rng.integers(1, 90, 300), [40_000] + [1] * 50):
        lengths = np.array(lengths)
        tokens, begins = lm.stream(lengths, lm.LANES)
        assert sorted(tokens[tokens >= 0].tolist()) == list(range(lengths.sum()))
        assert begins.sum() == len(lengths) and begins[0]
        assert np.all((np.diff(tokens, axis=0) == 1) | (tokens[1:] == -1))  # a lane reads on in order
        assert tokens.shape[1] <= lm.LANES and (tokens < 0).sum() < tokens.shape[1]


def test_base_scores_follow_brute_force_and_the_model_learns(spark):
    import random

    from .conftest import sentence

    rng = random.Random(2)
    kinds = [lambda: sentence(rng, 60), lambda: " ".join(rng.choice(["und", "der", "die", "das", "ist", "ein"]) for _ in range(60))]
    rows = [(i, kinds[i % 2]()) for i in range(400)] + [(400, None), (401, ""), (402, "Never SEEN at\x0ball"), (3, "again w"), (3, "again w")]
    got = lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    tokens = lambda t: [w for w in (t or "").encode().lower().split()] + [None]
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = Counter((i, held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)),
                    round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)), 6)) for i, t in rows)
    assert want == Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got)
    assert {r["train_tokens"] for r in got} == {n}
    out = [r for r in got if r["held_out"] and r["n_tokens"] > 5]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_empty_table(spark, none):
    assert lm.score_documents(none.select("doc_id", "text")).count() == 0


def test_frequent_words_are_bounded_and_the_most_frequent(spark):
    rows = [(f"w{i}", 0, 1000 // (i + 1) + 1) for i in range(500)]
    counts = spark.createDataFrame(rows, "word string, look int, c long")
    for most in (0, 1, 10, 100, 1000):
        got = lm.frequent_words(counts, most)
        assert len(got) <= most
        assert got == sorted(((w, c) for w, _, c in rows), key=lambda x: (-x[1], x[0]))[:len(got)]
    assert len(lm.frequent_words(counts, 1000)) == 500


def test_the_rounds_train_on_every_training_document_once(spark, monkeypatch):
    """Before, three quarters of the training documents reached no round."""
    trained = []
    real = lm.share
    monkeypatch.setattr(lm, "share", lambda docs, k: (trained.extend(r["doc_id"] for r in real(docs, k).collect()), real(docs, k).limit(0))[1])
    docs = lm.with_keys(spark.createDataFrame([(k, f"text number {k}") for k in range(300)], "doc_id long, text string"))
    lm.train(docs, lm.Model([("text", 300)], lm.np.full(lm.ENDINGS * lm.MARKS, 0.5), 300))
    assert sorted(trained) == sorted(r["doc_id"] for r in docs.where("not held_out").collect())

from __future__ import annotations

import numpy as np

from incidentlens.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20, every=20):
    sound = {}
    for i, v, _ in rows:
        if v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            sound[i] = np.array(v, np.float32).astype(float)
    out = {}
    for q in sorted(i for i in sound if i % every == 0):
        scored = sorted((-float(np.einsum("i,i", sound[q], x)), i) for i, x in sound.items() if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_neighbours_of_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)], 0) for i in range(400)]
    rows += [(400 + i, rows[0][1], 1) for i in range(120)]  # a large group of equal vectors
    rows += [(1000, None, 0), (1001, [0.0] * 8, 0), (1002, [1.0, None] + [0.0] * 6, 0), (1003, [float("nan")] * 8, 0),
             (1004, [float("inf")] + [0.0] * 7, 0), (1005, [1.0, 2.0], 0), rows[20]]
    got = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(rows)
    assert set(got) == set(want)
    hit = total = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and q not in [f[1] for f in found]
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        hit += len({f[1] for f in found} & {i for i, _ in want[q]})
        total += 20
    assert hit / total >= 0.95
    assert [f[1] for f in sorted(got[0])[:20]] == [i for i, _ in want[0]]  # equal vectors: the smallest ids


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (7, [0.5, 0.5], 0)], SCHEMA)
    assert [tuple(r) for r in neighbours.nearest(few).collect()] == [(0, 1, 7, 0.5)]
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_leaves_are_dealt_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CHUNK", 16)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)], 0) for i in range(300)]
    got = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert all(set(got[q]) == {i for i, _ in found} for q, found in brute(rows).items())


def test_ties_of_different_vectors_go_to_the_smaller_id(spark):
    """475 distinct vectors with one inner product to the query, in any order: the smallest ids are the answer."""
    import random

    import numpy as np

    rng = np.random.default_rng(3)
    rows = [(0, [1.0] + [0.0] * 7)]
    for i in range(1, 476):
        v = rng.normal(size=7)
        rows.append((i, [1.0, *(v / np.linalg.norm(v) * 0.5).tolist()]))
    rows += [(500 + i, [0.3, *rng.normal(size=7).tolist()]) for i in range(50)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = neighbours.nearest(df).where("query_id = 0").orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == list(range(1, 21)) and {r["score"] for r in got} == {1.0}


def test_best_rows_equal_a_full_sort():
    import numpy as np

    rng = np.random.default_rng(5)
    matrix, q = rng.integers(-2, 3, (300, 4)).astype(float), rng.integers(-2, 3, (40, 4)).astype(float)
    ids = rng.permutation(300) * 7
    got = [[] for _ in q]
    for of, row, score in neighbours.best_of(q, matrix, ids, 21, at_once=97):
        for i, r, x in zip(of, row, score):
            got[i].append((-x, ids[r]))
    for i, found in enumerate(got):
        assert found == sorted((-float(q[i] @ m), x) for m, x in zip(matrix, ids))[:21]
    assert sum(len(o) for o, _, _ in neighbours.best_of(q, matrix[:3], ids[:3], 21)) == 120

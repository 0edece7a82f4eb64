from __future__ import annotations

import random
import zlib

from incidentlens.llm import sharding


def check(df, n=40):
    rows = sharding.shard(df, n).collect()
    src = sorted(((r["doc_id"] is not None, r["doc_id"]), (r["text"] or "").encode()) for r in df.select("doc_id", "text").collect())
    got = sorted(((r["doc_id"] is not None, r["doc_id"]), r["size"], r["text_crc32"]) for r in rows)
    assert got == sorted((i, len(t) + 16, zlib.crc32(t)) for i, t in src)
    by: dict[int, list] = {}
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < n
        by.setdefault(r["shard"], []).append(r)
    total, largest = sum(r["size"] for r in rows), max((r["size"] for r in rows), default=0)
    for s, own in by.items():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / n) <= 2 * largest
    last = None
    for s in sorted(by):  # contiguous in the order of ids
        ids = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in by[s]]
        assert last is None or min(ids) >= last
        last = max(ids)
    return rows


def test_shards_are_balanced_contiguous_and_gapless(spark):
    rng = random.Random(0)
    rows = [(i, "é" * rng.randint(0, 400)) for i in range(3000)] + [(7, "same")] * 500
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))


def test_odd_rows(odd, none):
    check(odd, 3)
    assert sharding.shard(none).count() == 0

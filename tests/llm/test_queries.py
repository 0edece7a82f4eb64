"""Every query over the smallest test data, the components helper, and the pipeline."""

from __future__ import annotations

import random

import pytest

from incidentlens.llm import graph, queries
from incidentlens.llm.common import table

SF = "/root/testdata/sf0.001"
ROWS = {"op2_html_extraction": "pages"}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs_over_the_whole_table(spark, name):
    df = queries.QUERIES[name](spark, SF)
    n = df.count()
    if name in ("op4_nearest_neighbours", "op7_substring_dedup"):
        assert n > 0
    else:
        assert n == table(spark, SF, ROWS.get(name, "documents")).count()


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [
        (500, k) for k in range(501, 600)] + [(None, 3), (4, 4)]
    parent = list(range(700))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    nodes = {x for e in edges if e[0] is not None and e[0] != e[1] for x in e}
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in nodes}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = table(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        docs = out.cache()
        assert 0 < docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.columns == [*columns, "ids", "n_tokens"] and last.count() == docs.count()
    assert corpus_pipeline.run(spark, SF).count() == last.count() and before > 0

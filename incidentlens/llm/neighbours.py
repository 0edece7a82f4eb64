"""Approximate nearest neighbours: a forest of random-projection trees and a shared priority queue.

Trees are fitted on a bounded sample; every distinct vector is indexed in each tree. A query
walks all trees with one queue of branches, best margin first, until the leaves it has met hold
enough vectors; these are reranked by their exact inner product in double precision. For the
walk, vectors get one more coordinate that makes their lengths equal, so that the largest inner
product is the nearest direction.

Equal vectors are one point of the index with their ``k + 1`` smallest ids: no answer can hold
more of them. Leaves that cannot be split are dealt over chunks, each query goes to all chunks.

Defined results: vectors that are NULL, zero, hold NULL or non-finite components, or are not of
the commonest length take no part; ties go to the smaller id; repeated ids count once; an empty
table gives an empty result; with fewer than ``k`` others, all that are found are returned.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Shared, stored, table

#: Documented bound of the sample that the split planes are fitted on (smallest hash first).
MAX_SAMPLE = 20_000
TREES = 8
#: Vectors of one leaf aimed at, over the whole table; where the search covers a share of the table,
#: a tree has at most WIDE leaves, so that a query meets a fixed number of them.
LEAF, WIDE = 256, 64
#: A query's search ends when its leaves hold this share of all vectors (each counted once per
#: tree). Vectors without structure, as in the test data, need this much for a recall of 0.9;
#: for embeddings with structure give ``nearest`` a fixed ``search`` instead.
SEARCH_SHARE = 1.0
#: ... and at least this many, which in small tables is most of the forest.
MIN_SEARCH = 4000
#: Vectors of one chunk of a leaf.
CHUNK = 4096
TRIES = 4


class Forest:
    """Split planes of all trees in flat arrays; children below zero are leaves (-1 - leaf number)."""

    def __init__(self, sample: np.ndarray, n_total: int, leaf: int = LEAF, trees: int = TREES, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.normal, self.cut, self.child, self.roots = [], [], [], []
        self.leaves = 0
        small = max(4, int(leaf * len(sample) / max(n_total, 1)))
        for _ in range(trees):
            self.roots.append(self._split(sample, np.arange(len(sample)), small, rng))
        d = sample.shape[1]
        self.normal = np.array(self.normal, np.float32).reshape(-1, d)
        self.cut = np.array(self.cut, np.float32)
        self.child = np.array(self.child, np.int64).reshape(-1, 2)

    def _split(self, x: np.ndarray, own: np.ndarray, small: int, rng) -> int:
        if len(own) > small:
            planes = rng.standard_normal((TRIES, x.shape[1]))
            planes /= np.linalg.norm(planes, axis=1, keepdims=True)
            side = x[own] @ planes.T
            best = int(side.std(axis=0).argmax())
            side, cut = side[:, best], float(np.median(side[:, best]))
            right = side > cut
            if 0 < right.sum() < len(own):
                at = len(self.cut)
                self.normal.append(planes[best])
                self.cut.append(cut)
                self.child.append([0, 0])
                self.child[at] = [self._split(x, own[~right], small, rng), self._split(x, own[right], small, rng)]
                return at
        self.leaves += 1
        return -self.leaves

    def leaf_of(self, x: np.ndarray, root: int) -> np.ndarray:
        """Leaf number of each row in one tree."""
        node = np.full(len(x), root, np.int64)
        live = np.flatnonzero(node >= 0)
        while len(live):
            at = node[live]
            right = np.einsum("ij,ij->i", x[live], self.normal[at]) > self.cut[at]
            node[live] = self.child[at, right.astype(np.int64)]
            live = live[node[live] >= 0]
        return -1 - node

    def probes(self, q: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
        """Leaves for one query, from a queue shared by all trees (smallest distance to the cell first)."""
        queue = [(0.0, int(r)) for r in self.roots]
        out, met = [], 0
        while queue and met < enough:
            far, node = heapq.heappop(queue)
            while node >= 0:
                m = float(q @ self.normal[node] - self.cut[node])
                near, other = (1, 0) if m > 0 else (0, 1)
                heapq.heappush(queue, (max(far, abs(m)), int(self.child[node, other])))
                node = int(self.child[node, near])
            leaf = -1 - node
            if counts[leaf]:
                out.append(leaf)
                met += int(counts[leaf])
        return out


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, v an array of floats or doubles as in the table."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("v"))
    sound = v.where("vec_id is not null and v is not null and size(v) > 0 "
                    "and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
                    "and exists(v, x -> x <> 0)")
    lengths = sound.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return sound.where(F.size("v") == (lengths[0]["d"] if lengths else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Rows with the coordinate that makes all lengths equal, in single precision for the walk."""
    rest = np.sqrt(np.maximum(longest ** 2 - (x ** 2).sum(axis=1), 0.0))
    return (np.column_stack([x, rest]) / longest).astype(np.float32)


def best_of(q: np.ndarray, matrix: np.ndarray, ids: np.ndarray, k: int, at_once: int = 200_000):
    """(query, row, score) arrays of the ``k`` best rows of ``matrix`` for each query, ties to the smaller of ``ids``.

    A matrix product finds the rows that may reach the k-th score; sums in one order then give scores that are the same wherever a
    pair meets, and only these decide."""
    rough = q @ matrix.T
    kth = min(k, rough.shape[1]) - 1
    slack = 1e-9 * np.linalg.norm(q, axis=1) * np.linalg.norm(matrix, axis=1).max()
    reach = -np.partition(-rough, kth, axis=1)[:, kth] - slack
    near = rough >= reach[:, None]
    n = near.sum(axis=1)
    at = 0
    while at < len(q):  # as many queries as give so many pairs
        end = max(at + 1, int(np.searchsorted(np.cumsum(n[at:]), at_once, "right")) + at)
        of, row = np.nonzero(near[at:end])
        exact = np.concatenate([np.einsum("ij,ij->i", q[of[i:i + at_once] + at], matrix[row[i:i + at_once]])
                                for i in range(0, len(of), at_once)])
        order = np.lexsort((ids[row], -exact, of))
        of, row, exact = of[order], row[order], exact[order]
        first = np.searchsorted(of, of)
        keep = np.arange(len(of)) - first < k
        yield of[keep] + at, row[keep], exact[keep]
        at = end


def nearest(vectors: DataFrame, k: int = 20, query_every: int = 20, search: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every vector whose id is
    divisible by ``query_every`` among all others."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    # distinct vectors with their smallest ids
    first = Window.partitionBy("v").orderBy("vec_id")
    kept = rows.distinct().withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k + 1)
    of_kind = rows.schema["v"].dataType.simpleString()
    points = stored(kept.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                    .withColumn("point", F.col("ids")[0]), "ann-points")
    asked = stored(rows.where(F.col("vec_id") % query_every == 0).select(F.col("vec_id").alias("query_id"), F.col("v").alias("qv"))
                   .distinct().join(points.select("v", "point"), F.col("qv") == F.col("v")).select("query_id", "point"), "ann-queries")
    stats = points.agg(F.count("*").alias("n"),
                       F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("m")).first()
    if not stats["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    longest = float(np.sqrt(stats["m"]))
    enough = search or max(MIN_SEARCH, int(SEARCH_SHARE * stats["n"]))
    sample = points.orderBy(F.xxhash64("point")).limit(MAX_SAMPLE).select("v").toArrow().column(0).combine_chunks()
    leaf = LEAF if search else max(LEAF, stats["n"] // WIDE + 1)
    forest = Forest(_lifted(_matrix(sample), longest).astype(np.float64), stats["n"], leaf)
    shared = Shared(spark, (forest, longest))

    def index(batches):
        trees, top = shared.get()
        for b in batches:
            x = _matrix(b.column(1))
            if not len(x):
                continue
            lifted = _lifted(x, top)
            for root in trees.roots:
                leaf = trees.leaf_of(lifted, root)
                yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), b.column(0), b.column(1)],
                                                 names=["leaf", "point", "v"])

    placed = points.select("point", "v").mapInArrow(index, f"leaf int, point long, v {of_kind}")
    counts = np.zeros(forest.leaves, np.int64)
    for r in placed.select("leaf").groupBy("leaf").count().collect():  # one number per leaf of the fitted forest
        counts[r["leaf"]] = r["count"]
    counted = Shared(spark, counts)

    def walk(batches):
        (trees, top), counts = shared.get(), counted.get()
        for b in batches:
            x = _matrix(b.column(1))
            for point, v, raw in zip(b.column(0).to_pylist(), x, b.column(1)):
                q = np.append(v / np.linalg.norm(v), 0.0).astype(np.float32)
                found = trees.probes(q, counts, enough)
                parts = [(leaf, c) for leaf in found for c in range(int(counts[leaf]) // CHUNK + 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.int32()),
                     pa.array([1] * len(parts), pa.int32()), pa.array([point] * len(parts), pa.int64()),
                     pa.array([raw.as_py()] * len(parts), b.column(1).type)],
                    names=["leaf", "chunk", "is_query", "point", "v"])

    chunks = np.maximum(counts // CHUNK + 1, 1)
    several = [(int(i), int(chunks[i])) for i in np.flatnonzero(chunks > 1)]
    chunk = F.lit(0)
    if several:  # leaves too large for one place; their number is bounded by the forest
        parts = F.broadcast(spark.createDataFrame(several, "leaf int, parts int"))
        placed = placed.join(parts, "leaf", "left")
        chunk = F.coalesce(F.pmod(F.xxhash64("point"), F.col("parts")), F.lit(0)).cast("int")
    queries = points.select("point", "v").join(asked.select("point").distinct(), "point", "left_semi")
    both = (placed.select("leaf", chunk.alias("chunk"), F.lit(0).alias("is_query"), "point", "v")
            .unionByName(queries.select("point", "v").mapInArrow(
                walk, f"leaf int, chunk int, is_query int, point long, v {of_kind}")))

    def rerank(batches):
        now, ids, held = None, [], []
        matrix = None
        for b in batches:
            leaf, part, is_query, point = (b.column(i).to_numpy() for i in range(4))
            x = _matrix(b.column(4))
            border = np.flatnonzero(np.concatenate([[True], (leaf[1:] != leaf[:-1]) | (part[1:] != part[:-1])
                                                    | (is_query[1:] != is_query[:-1])]))
            out = ([], [], [])
            for s, e in zip(border, np.append(border[1:], len(leaf))):
                if (leaf[s], part[s]) != now:
                    now, ids, held, matrix = (leaf[s], part[s]), [], [], None
                if not is_query[s]:
                    ids.append(point[s:e])
                    held.append(x[s:e])
                    continue
                if not held:
                    continue
                if matrix is None:
                    matrix, own = np.concatenate(held), np.concatenate(ids)
                for at in range(s, e, 512):
                    q, qid = x[at:min(at + 512, e)], point[at:min(at + 512, e)]
                    for part_, place, exact in best_of(q, matrix, own, k + 1):
                        out[0].append(qid[part_])
                        out[1].append(own[place])
                        out[2].append(exact)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], names=["q", "point", "score"])

    placed_all = both.repartition("leaf", "chunk").sortWithinPartitions("leaf", "chunk", "is_query")
    met = placed_all.mapInArrow(rerank, "q long, point long, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "point")
    met = met.groupBy("q", "point").agg(F.max("score").alias("score"))
    top = met.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1)
    # from points back to ids, then from query points back to queries
    ids = (top.join(points.select("point", "ids"), "point").select("q", "score", F.explode("ids").alias("vec_id")))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    ids = ids.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k + 1)
    lists = stored(ids.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("_r", "vec_id", "score"))).alias("found")), "ann-lists")
    out = asked.join(lists, F.col("point") == F.col("q"))
    out = out.select("query_id", F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k).alias("found"))
    return (out.select("query_id", F.posexplode("found").alias("p", "f"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), "f.vec_id", "f.score"))


def op4_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))

"""Exact top-k inner-product search with ball trees per shard.

Vectors are spread over shards by a hash of their id; each shard holds one ball
tree (centre, radius and row range per node; median split on the widest dimension).  A query
walks a tree best-first: nodes wait in a heap by their upper bound
<q, centre> + |q| * radius, and the walk ends when the best bound is below the
k-th score known so far.  That score is shared: queries go in blocks, each
block is first searched in one shard, and its k-th scores then start the search of all other
shards.  A tree is built once and written out; blocks x shards are independent tasks.

Components are integers.  Scores are exact 64-bit integers; bounds are doubles with a
margin on the safe side, so they decide only what is looked at.
"""

from __future__ import annotations

import heapq
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowcube.operators.materialize import materialize
from flowcube.sources.tables import table

K = 20
#: Vectors in a shard and queries in a block, about.
SHARD_ROWS, BLOCK_ROWS, LEAF = 8_192, 2_048, 128
SCALE = 64


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v, dim): floor(scale * x) of every component; invalid vectors left out, one vector per vec_id."""
    ok = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & F.forall(
        "embedding", lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    v = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    rows = vectors.filter(ok).select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def build(pdf: pd.DataFrame) -> pd.DataFrame:
    """Ball tree of one shard as arrays: node ranges, children, centres, radii; vectors in tree order."""
    v = np.array(pdf["v"].tolist(), dtype=np.int64).reshape(len(pdf), -1)
    ids = pdf["vec_id"].to_numpy(dtype=np.int64)
    order = np.argsort(ids, kind="stable")
    f = v.astype(np.float64)
    nodes, centres, todo = [], [], [(0, len(ids), -1)]
    while todo:
        lo, hi, parent = todo.pop()
        me = len(nodes)
        if parent >= 0:
            nodes[parent][2 if nodes[parent][2] < 0 else 3] = me
        part = f[order[lo:hi]]
        centre = part.mean(axis=0)
        radius = float(np.sqrt(((part - centre) ** 2).sum(axis=1).max())) if hi > lo else 0.0
        nodes.append([lo, hi, -1, -1, radius])
        centres.append(centre)
        spread = part.max(axis=0) - part.min(axis=0) if part.shape[1] else np.zeros(1)
        if hi - lo > LEAF and spread.max() > 0:
            axis, mid = int(spread.argmax()), (hi - lo) // 2
            order[lo:hi] = order[lo:hi][np.argsort(part[:, axis], kind="stable")]
            todo += [(lo, lo + mid, me), (lo + mid, hi, me)]
    return pd.DataFrame({
        "dim": [int(pdf["dim"].iloc[0])], "shard": [int(pdf["shard"].iloc[0])], "ids": [ids[order].tobytes()],
        "vecs": [v[order].tobytes()], "nodes": [np.array(nodes, dtype=np.float64).tobytes()],
        "centres": [np.array(centres, dtype=np.float64).tobytes()]})


class Tree:
    """One shard's tree, unpacked once for all queries of a block."""

    def __init__(self, row, dim: int):
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.vecs = np.frombuffer(row["vecs"], dtype=np.int64).reshape(len(self.ids), dim)
        nodes = np.frombuffer(row["nodes"], dtype=np.float64).reshape(-1, 5)
        self.radius, self.links = nodes[:, 4], nodes[:, :4].astype(int).tolist()
        self.centres = np.frombuffer(row["centres"], dtype=np.float64).reshape(len(nodes), dim)
        self.floats = self.vecs.astype(np.float64)
        self.largest = float(np.abs(self.floats).max(initial=0.0))
        self.margin = float(np.abs(self.centres).max(initial=0.0)) + self.radius


def walk(q: np.ndarray, own: int, floor: int | None, k: int, tree: Tree) -> list[tuple[int, int]]:
    """Best (score, vec_id) of one tree that can reach the k-th score ``floor``; best first, ties to smaller ids."""
    qf = q.astype(np.float64)
    norm = float(np.sqrt(qf @ qf))
    big = float(np.abs(qf).sum()) * tree.largest
    exact = big < 2.0**53  # then doubles hold every product and sum exactly
    if big >= 2.0**63:
        raise OverflowError("inner products beyond 64 bits")
    bounds = tree.centres @ qf + norm * tree.radius
    bounds = (bounds + 1e-9 * (np.abs(bounds) + norm * tree.margin) + 1e-6).tolist()
    best: list[tuple[int, int]] = []  # min-heap of (score, -vec_id)
    heap, limit = [(-bounds[0], 0)], floor
    while heap:
        bound, at = heapq.heappop(heap)
        if limit is not None and -bound < limit:
            break
        lo, hi, left, right = tree.links[at]
        if left >= 0:
            for child in (left, right):
                if limit is None or bounds[child] >= limit:
                    heapq.heappush(heap, (-bounds[child], child))
            continue
        scores = tree.floats[lo:hi] @ qf if exact else tree.vecs[lo:hi] @ q
        near = range(hi - lo) if limit is None else np.nonzero(scores >= limit)[0].tolist()
        for i in near:
            item = (int(scores[i]), -int(tree.ids[lo + i]))
            if -item[1] == own:
                continue
            if len(best) < k:
                heapq.heappush(best, item)
            elif item > best[0]:
                heapq.heapreplace(best, item)
        if len(best) == k and (limit is None or best[0][0] > limit):
            limit = best[0][0]
    return [(s, -i) for s, i in sorted(best, reverse=True)]


def search(queries: DataFrame, trees: DataFrame, k: int) -> DataFrame:
    """Cogroup query rows (dim, shard, block, vec_id, v, floor) with tree rows (dim, shard, block, ...)."""
    def run(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(t):
            tree = Tree(t.iloc[0], int(t["dim"].iloc[0]))
            for own, v, floor in zip(q["vec_id"], q["v"], q["floor"]):
                floor = None if pd.isna(floor) else int(floor)
                out += [(int(own), i, s) for s, i in walk(np.asarray(v, dtype=np.int64), int(own), floor, k, tree)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    keys = ["dim", "shard", "block"]
    return queries.groupBy(*keys).cogroup(trees.groupBy(*keys)).applyInPandas(run, "query_id bigint, vec_id bigint, score bigint")


def top_k(vectors: DataFrame, is_query, k: int = K, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best inner products of every query row with all other rows.

    ``is_query`` is a condition on vec_id.  Null vectors, vectors with null or non-finite components and
    rows with a null vec_id take no part; rows that repeat a vec_id count once (the least vector); only
    vectors of equal length are compared; ties go to the smaller vec_id; fewer than k candidates give
    fewer rows; an empty table gives an empty result.  Other columns are not read.
    """
    rows = materialize(quantised(vectors))
    n, n_queries = rows.count(), rows.filter(is_query).count()
    shards, blocks = max(1, ceil(n / shard_rows)), max(1, ceil(n_queries / block_rows))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    trees = materialize(rows.groupBy("dim", "shard").applyInPandas(
        build, "dim int, shard int, ids binary, vecs binary, nodes binary, centres binary"))
    queries = rows.filter(is_query).select("dim", "vec_id", "v", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"))
    home = F.pmod("block", F.lit(shards))
    # every block in its home shard, without a known k-th score
    first = materialize(search(
        queries.withColumn("shard", home).withColumn("floor", F.lit(None).cast("bigint")),
        trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).filter(F.col("shard") == home), k))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floors = first.withColumn("r", F.row_number().over(rank)).filter(F.col("r") == k).select(
        F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    rest = search(
        queries.join(floors, "vec_id", "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter(
            F.col("shard") != home),
        trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).filter(F.col("shard") != home), k)
    return first.unionByName(rest).withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op1_ball_tree_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best integer inner products of every vector whose vec_id is divisible by 20."""
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


ORACLE_OP1 = f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
u AS (SELECT vec_id, unnest(v) AS c, generate_subscripts(v, 1) AS i FROM e),
s AS (SELECT q.vec_id AS query_id, b.vec_id, CAST(sum(q.c * b.c) AS BIGINT) AS score
      FROM u q JOIN u b ON q.i = b.i AND q.vec_id <> b.vec_id WHERE q.vec_id % 20 = 0 GROUP BY ALL)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= {K}
"""

QUERIES = {"op1_ball_tree_top20": op1_ball_tree_top20}
ORACLE = {"op1_ball_tree_top20": ORACLE_OP1}

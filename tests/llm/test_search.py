import math
import random

import numpy as np
import pytest

from flowcube.llm import ball_tree
from pyspark.sql import functions as F

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k=20):
    seen = {}
    for i, v, _ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(64 * float(np.float32(x))) for x in v]
        seen[i] = min(seen.get(i, q), q)
    out = set()
    for i, q in seen.items():
        if i % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in seen.items() if j != i and len(v) == len(q))
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])}
    return out


def vectors():
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], 0) for i in range(600)]
    rows += [(i, [1.0] * 8, 0) for i in range(600, 640)]  # ties
    rows += [(640, None, 0), (660, [float("nan")] * 8, 0), (680, [None] + [1.0] * 7, 0), (700, [float("inf")] * 8, 0),
             (None, [1.0] * 8, 0), (720, [2.0, 1.0], 0), (721, [1.0, 1.0], 0), (0, [0.5] * 8, 1), (740, [], 0), (741, [], 0)]
    return rows


def test_top_k_matches_brute_force_over_shards_and_blocks(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA)
    got = ball_tree.top_k(df, F.col("vec_id") % 20 == 0, shard_rows=150, block_rows=10)
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert ball_tree.top_k(df, F.col("vec_id") % 20 == 0).count() == 0


def test_large_finite_components_are_not_left_out(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [float(2**50), 0.0], 0), (2, [2.0, 0.0], 0)]
    got = ball_tree.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0).collect()
    assert {tuple(r) for r in got} == brute(rows)
    beyond = spark.createDataFrame([(0, [1.0], 0), (1, [1e30], 0)], SCHEMA)
    with pytest.raises(Exception, match="beyond 64 bits"):
        ball_tree.top_k(beyond, F.col("vec_id") % 20 == 0).collect()

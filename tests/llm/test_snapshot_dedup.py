from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowcube.llm import snapshot_dedup as S


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = Counter()
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0), reverse=True)
        for n, i in enumerate(ids):
            out[(i, ids[0], len(ids), n == 0, sha256(text.encode()).hexdigest())] += 1
    return out


def got(df):
    return Counter((r.doc_id, r.keep_id, r.n, r.kept, bytes(r.sha).hex()) for r in df.collect())


@pytest.mark.parametrize("n", [1, 2, 5, 100, 5000, 60_000])
def test_filter_knows_its_keys_and_few_others(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(-2**63, 2**63 - 1, n)
    parts = S.fuse_filter(np.concatenate([keys, keys[:1]]))
    assert S.known(keys, *parts).all()
    others = rng.integers(-2**63, 2**63 - 1, 50_000)
    assert S.known(others, *parts).mean() < 0.01
    if n >= 5000:
        assert len(parts[3]) < 1.4 * n  # a byte a key and little more


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_equals_grouping_by_text(docs, rows, batches):
    assert got(S.decide(docs, batches)) == brute(rows)


def test_equal_digests_of_different_texts(docs, rows):
    """A digest of a few values: filters know nearly all, bytes decide."""
    weak = lambda c: F.pmod(F.length(c), F.lit(7)).cast("bigint")
    assert got(S.decide(docs, 3, weak)) == brute(rows)


def test_collision_across_batches_only(spark):
    rows = [(1, "aa"), (2, "bb"), (3, "aa"), (4, "ccc"), (5, "bb"), (6, "dddd")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(S.decide(docs, 3, lambda c: F.length(c).cast("bigint"))) == brute(rows)


def test_screen_passes_every_copy_and_few_others(spark):
    old = S.snapshot(spark.range(5000).selectExpr("id as doc_id", "concat('text ', id) as text"))
    new = S.snapshot(spark.range(4000, 9000).selectExpr("id as doc_id", "concat('text ', id) as text"))
    passed = {r.key for r in S.screen(old, new).collect()}
    both = {r.key for r in S.byte_checks(old, new).filter("same").collect()}
    assert len(both) == 1000 and both <= passed and len(passed) < 1100


def test_many_equal_rows_without_id_and_text(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 7)
    rows = [(None, None)] * 100 + [(7, "")] * 30 + [(i, f"t{i}") for i in range(20)] + [(3, "t3")] * 8
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert got(S.decide(docs)) == brute(rows)


def test_empty_table_and_clashing_columns(spark, empty):
    assert S.decide(empty).collect() == []
    rows = [(1, "a", 5, b"x"), (2, "a", 6, b"y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, key bigint, sha binary")
    assert got(S.decide(docs)) == brute(rows)

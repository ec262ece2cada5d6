"""Exact removal of repeated texts, batch by batch, against immutable snapshots.

A batch becomes a snapshot once and is never changed:

* exact buckets: a table bucketed by the 64-bit digest of the text, with the texts themselves, the
  number of rows and the largest doc_id.  Rows of one batch meet here first: one grouping by digest, combined
  before the shuffle, so a text that a third of all rows hold travels once per task;
* one static binary fuse filter (three places, 8-bit fingerprints, about nine bits a digest) per
  shard of some 200,000 digests.

The distinct digests of a later batch are screened by the filters: a digest that no filter knows is new, without a
look at any stored text.  Positives (copies, and one in 256 of the rest) join the exact buckets, and only equal bytes count
as a copy.  Buckets are laid out by digest, so neither side's texts are shuffled for the join.
Digests that different texts share (in a batch or across) go through a grouping by the text itself.

Defined cases: null texts count as empty; empty texts are copies of each other.  Of equal texts the row with
the largest doc_id stays; null doc_ids are the smallest; of rows equal in text and doc_id one stays.  Only doc_id
and text are read, whatever other columns there are.  An empty table gives no rows.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowcube.llm.common import documents
from flowcube.operators.materialize import materialize
from flowcube.session import ensure_checkpoint_dir

#: Digests per filter.
SHARD_KEYS = 200_000
#: Batches that op13 cuts its table into, by ranges of doc_id (later batches hold larger ids).
BATCHES = 3
#: Copies equal in text and doc_id that one task writes at once.
CHUNK = 100_000
#: A text with more than one in so many rows is joined by broadcast (at most so many texts).
HOT = 1000

FILTER = "shard int, seed bigint, segment int, segments int, body binary"


# ---- binary fuse filter -------------------------------------------------------------------------------------------

def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit keys to well mixed 64-bit values, another set for each seed."""
    h = keys + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def places(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """Three places per key, in three neighbouring segments."""
    mask = np.uint64(segment - 1)
    first = ((h >> np.uint64(32)) * np.uint64(segment * segments)) >> np.uint64(32)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64)


def fingerprints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(255)).astype(np.uint8)


def fuse_filter(keys: np.ndarray) -> tuple[int, int, int, np.ndarray]:
    """Seed, segment length, segments and the bytes of a filter that holds all of ``keys`` (at least one)."""
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    segment = 1 << max(2, min(18, int(math.log(n) / math.log(3.33) + 2.25)))
    room = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    segments = max(1, math.ceil(room / segment) - 2)
    for seed in range(1000):
        h = mixed(keys, seed)
        spots = places(h, segment, segments)
        size = segment * (segments + 2)
        count = np.bincount(spots.ravel(), minlength=size)
        sums = np.zeros(size, dtype=np.int64)  # xor of the numbers of the keys at a place
        for spot in spots:
            np.bitwise_xor.at(sums, spot, np.arange(n))
        layers, ready, left = [], np.flatnonzero(count == 1), n
        while len(ready):
            alone, first = np.unique(sums[ready], return_index=True)
            layers.append((alone, ready[first]))
            left -= len(alone)
            touched = spots[:, alone].ravel()
            np.subtract.at(count, touched, 1)
            np.bitwise_xor.at(sums, touched, np.tile(alone, 3))
            touched = np.unique(touched)
            ready = touched[count[touched] == 1]
        if left == 0:
            body, marks = np.zeros(size, dtype=np.uint8), fingerprints(h)
            for alone, spot in reversed(layers):  # a layer's own places are still 0 and touch no other key of the layer
                body[spot] = marks[alone] ^ np.bitwise_xor.reduce(body[spots[:, alone]], axis=0)
            return seed, segment, segments, body
    raise ValueError("no seed gives a filter")


def known(keys: np.ndarray, seed: int, segment: int, segments: int, body: np.ndarray) -> np.ndarray:
    """True for every key of the filter, and for about one in 256 of the others."""
    h = mixed(keys.astype(np.uint64), seed)
    return np.bitwise_xor.reduce(body[places(h, segment, segments)], axis=0) == fingerprints(h)


# ---- snapshots ----------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Snapshot:
    """An immutable batch: ``table`` (key, n, last, texts) is bucketed by key; ``filters`` screen its keys."""
    table: str
    filters: DataFrame | None
    shards: int
    keys: int


def _shard(shards: int) -> Column:
    return F.pmod(F.col("key"), F.lit(shards)).cast("int")


def snapshot(rows: DataFrame, key=F.xxhash64, screened: bool = True) -> Snapshot:
    """Write ``rows`` (doc_id, text) as a snapshot; without ``screened`` no filters are built (nothing follows)."""
    spark = rows.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    groups = (rows.select("doc_id", text.alias("text")).withColumn("key", key(F.col("text"))).groupBy("key")
              .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"), F.collect_set("text").alias("texts")))
    name = f"snapshot_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/materialized/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (groups.write.format("parquet").option("path", path).option("compression", "zstd")
     .bucketBy(buckets, "key").saveAsTable(name))
    keys = spark.table(name).select("key")
    many = keys.count()
    shards = max(1, math.ceil(many / SHARD_KEYS))

    def build(shard, pdf):
        import pandas as pd
        seed, segment, segments, body = fuse_filter(pdf["key"].to_numpy())
        return pd.DataFrame([[shard[0], seed, segment, segments, body.tobytes()]],
                            columns=["shard", "seed", "segment", "segments", "body"])

    filters = None
    if screened:
        filters = materialize(keys.withColumn("shard", _shard(shards)).groupBy("shard").applyInPandas(build, FILTER))
    return Snapshot(name, filters, shards, many)


def screen(old: Snapshot, new: Snapshot) -> DataFrame:
    """Keys of ``new`` that the filters of ``old`` know: all that ``old`` holds, and few others."""
    spark = old.filters.sparkSession
    # a batch larger than the snapshot meets copies of each filter
    copies = max(1, math.ceil(new.keys / (old.shards * SHARD_KEYS)))
    keys = spark.table(new.table).select("key", _shard(old.shards).alias("shard"),
                                         F.pmod(F.xxhash64("key"), F.lit(copies)).cast("int").alias("copy"))
    filters = old.filters.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))

    def probe(left, right):
        if not len(left) or not len(right):
            return left[["key"]].iloc[:0]
        f = right.iloc[0]
        hit = known(left["key"].to_numpy(), int(f["seed"]), int(f["segment"]), int(f["segments"]),
                    np.frombuffer(f["body"], dtype=np.uint8))
        return left.loc[hit, ["key"]]

    return keys.groupBy("shard", "copy").cogroup(filters.groupBy("shard", "copy")).applyInPandas(probe, "key bigint")


def byte_checks(old: Snapshot, new: Snapshot) -> DataFrame:
    """Keys held by both snapshots, and whether each holds one text under it and the bytes are equal (``same``)."""
    spark = old.filters.sparkSession
    held = spark.table(old.table).select("key", F.col("texts").alias("stored"))
    hits = spark.table(new.table).select("key", "texts").join(materialize(screen(old, new)), "key", "left_semi")
    one = (F.size("texts") == 1) & (F.size("stored") == 1)
    return hits.join(held, "key").select("key", (one & (F.get("texts", F.lit(0)) == F.get("stored", F.lit(0)))).alias("same"))


def repeated_texts(batches: list[DataFrame], key=F.xxhash64) -> DataFrame:
    """Every text that two rows or more of the batches hold: sha (binary), n rows, keep_id (largest doc_id)."""
    spark = batches[0].sparkSession
    snapshots: list[Snapshot] = []
    checks: list[DataFrame] = []
    for i, rows in enumerate(batches):
        new = snapshot(rows, key, screened=i + 1 < len(batches))
        checks += [byte_checks(old, new) for old in snapshots if old.keys and new.keys]
        snapshots.append(new)
    tables = [spark.table(s.table) for s in snapshots]
    checks += [t.filter((F.col("n") > 1) | (F.size("texts") > 1)).select("key", (F.size("texts") == 1).alias("same"))
               for t in tables]
    touched = materialize(reduce(DataFrame.unionAll, checks).groupBy("key").agg(F.min("same").alias("same")))

    sha = lambda c: F.unhex(F.sha2(c.cast("binary"), 256))
    plain = touched.filter("same").select("key")
    parts = [t.join(plain, "key", "left_semi").select("key", "n", "last", sha(F.get("texts", F.lit(0))).alias("sha"))
             for t in tables]
    found = (reduce(DataFrame.unionAll, parts).groupBy("sha")
             .agg(F.sum("n").alias("n"), F.max("last").alias("keep_id")))
    clash = touched.filter(~F.col("same")).select("key")
    if not clash.isEmpty():
        rows = reduce(DataFrame.unionAll, [b.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
                                           for b in batches])
        by_text = (rows.withColumn("key", key(F.col("text"))).join(clash, "key", "left_semi").groupBy("text")
                   .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last")))
        once = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two texts share a SHA-256"))).otherwise(F.max("n"))
        found = found.unionByName(by_text.groupBy(sha(F.col("text")).alias("sha"))
                                  .agg(once.alias("n"), F.max("last").alias("keep_id")).filter("n > 1"))
    return materialize(found)


def decide(docs: DataFrame, batches: int = BATCHES, key=F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: doc_id, sha (binary), keep_id, n (rows with the same text), kept."""
    rows = docs.select("doc_id", "text")
    cuts = []
    if batches > 1:
        at = rows.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 10_000)).first()[0] or []
        cuts = sorted(set(at))
    edges = [None, *cuts, None]
    parts = []
    for low, high in zip(edges, edges[1:]):
        inside = F.lit(True) if low is None else F.col("doc_id") > low
        if high is not None:
            inside = inside & (F.col("doc_id") <= high)
        if low is None:
            inside = F.col("doc_id").isNull() | inside
        parts.append(rows.filter(inside))
    found = repeated_texts(parts, key)

    # rows equal in text and doc_id are alike in every column returned: count them, decide once, write them out again
    digest = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
    ids = rows.select("doc_id", digest.alias("sha")).groupBy("doc_id", "sha").agg(F.count(F.lit(1)).alias("copies"))
    total = found.agg(F.sum("n")).first()[0] or 0
    hot = found.filter(F.col("n") * HOT > total)  # fewer than HOT texts
    rest = found.filter(F.col("n") * HOT <= total)
    ids = ids.join(F.broadcast(hot.withColumnRenamed("keep_id", "hot_id").withColumnRenamed("n", "hot_n")), "sha", "left")
    # a decided row must not crowd the second join: it looks for a value that no digest has
    spread = F.when(F.col("hot_n").isNull(), F.col("sha")).otherwise(F.unhex(F.md5(F.col("doc_id").cast("string").cast("binary"))))
    ids = ids.withColumn("look", spread).join(rest.withColumnRenamed("sha", "look"), "look", "left")
    last = F.when(F.col("hot_n").isNotNull(), F.col("hot_id")).when(F.col("n").isNotNull(), F.col("keep_id")).otherwise(F.col("doc_id"))
    ids = ids.select("doc_id", "sha", "copies", F.coalesce("hot_n", "n", F.lit(1)).cast("bigint").alias("n"), last.alias("keep_id"))

    few, many = ids.filter(F.col("copies") <= CHUNK), ids.filter(F.col("copies") > CHUNK)
    few = few.withColumn("chunk", F.lit(0).cast("bigint"))
    many = many.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(copies - 1) div {CHUNK}")))).repartition("sha", "chunk")
    here = F.least(F.lit(CHUNK), F.col("copies") - F.col("chunk") * CHUNK).cast("int")
    out = few.unionByName(many).withColumn("copy", F.explode(F.sequence(F.lit(1), here)))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chunk") == 0) & (F.col("copy") == 1)
    return out.select("doc_id", "sha", "keep_id", "n", kept.alias("kept"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", F.col("n").alias("group_size"), "kept", F.lower(F.hex("sha")).alias("text_sha256"))


QUERIES = {"op13_snapshot_dedup": op13}

ORACLE = {"op13_snapshot_dedup": """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  row_number() over (partition by t order by doc_id desc nulls last) = 1 as kept, sha256(t) as text_sha256
from (select doc_id, coalesce(text, '') as t from documents)
window same as (partition by t)"""}

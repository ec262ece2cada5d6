"""Balanced label propagation of documents over shards.

Documents with equal texts are linked.  Every document starts in the shard
given by its rank modulo the number of shards, so shard sizes differ by at most
one row.  A round then moves linked documents towards the shard that holds most
of their group.  Moves keep every shard's size: of the documents that want to
go from shard i to shard j, as many go as want to go back, and further ones
only against unlinked documents of j, which may lie anywhere.  These quotas come from
an (i, j) table of at most shards x shards rows, so the law ``rows`` (counts at
most one apart) holds after every round.  A group larger than a shard cannot be
whole; it fills the shards it is given as far as quotas go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowcube.llm.common import documents, order_key, ranked
from flowcube.operators.materialize import materialize

SHARDS = 8
ROUNDS = 4


def start_shards(docs: DataFrame, shards: int) -> DataFrame:
    """One row per document: identity, size, crc, text key and the shard of its rank."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("grp"), F.lit(0).alias("every"), order_key("doc_id").alias("ord"))
    return ranked(base, ["every"], "ord", "rid").withColumn("shard", (F.col("rid") % shards).cast("int")).drop("every")


def move_round(state: DataFrame, shards: int) -> DataFrame:
    """One round of label propagation under quotas; rows per shard stay as they are."""
    held = state.groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("c"))
    goal = held.groupBy("grp").agg(F.sum("c").alias("members"),
                                   F.max(F.struct("c", (-F.col("shard")).alias("s"))).alias("top"))
    # written out, so that the join deals both sides anew and a group of many copies can be split
    goal = materialize(goal.filter("members > 1").select("grp", (-F.col("top.s")).alias("goal")))
    wish = state.join(goal, "grp", "left").withColumn("linked", F.col("goal").isNotNull())
    wish = wish.withColumn("goal", F.coalesce("goal", "shard"))
    wish = materialize(wish)
    # what wants to leave i for j, and the unlinked rows each shard can give in exchange
    want = wish.filter("linked and goal <> shard").groupBy(F.col("shard").alias("i"), F.col("goal").alias("j")).agg(
        F.count(F.lit(1)).alias("w"))
    free = wish.filter("not linked").groupBy(F.col("shard").alias("j")).agg(F.count(F.lit(1)).alias("f"))
    back = want.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("w").alias("wb"))
    quota = want.join(back, ["i", "j"], "left").join(free, "j", "left").na.fill(0, ["wb", "f"])
    quota = quota.withColumn("over", F.greatest(F.col("w") - F.col("wb"), F.lit(0)))
    into = Window.partitionBy("j").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    quota = quota.withColumn("used", F.coalesce(F.sum("over").over(into), F.lit(0)))
    # unlinked rows of j in rank order: those from ``used`` on, ``swap`` many, go to i
    quota = quota.withColumn("swap", F.greatest(F.lit(0), F.least("over", F.col("f") - F.col("used"))))
    quota = materialize(quota.select("i", "j", "used", "swap", (F.least("w", "wb") + F.col("swap")).alias("go")))
    movers = ranked(wish.filter("linked and goal <> shard").withColumn(
        "ord", F.md5(F.concat(F.hex("grp"), F.col("ord")).cast("binary"))), ["shard", "goal"], "ord", "nth")
    moved = movers.join(quota.select(F.col("i").alias("shard"), F.col("j").alias("goal"), "go"), ["shard", "goal"])
    moved = moved.filter("nth < go").select("rid", F.col("goal").alias("to"))
    # at most shards x shards rows of quotas, so the range join is a broadcast of a bounded table
    slots = F.broadcast(quota.filter("swap > 0").select(F.col("j").alias("shard"), F.col("i").alias("to"), "used", "swap"))
    singles = ranked(wish.filter("not linked"), ["shard"], "ord", "nth")
    swapped = singles.join(slots, "shard").filter("nth >= used and nth < used + swap").select("rid", "to")
    new = wish.join(moved.unionByName(swapped), "rid", "left").withColumn("shard", F.coalesce("to", "shard"))
    return materialize(new.drop("to", "goal", "linked"))


def propagate(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, grp, ord, rid, shard) for every row of ``docs``.

    Null text counts as empty (size 1) and is linked with empty texts; repeated doc_ids and whole
    repeated rows are placed one by one; an empty table gives an empty result; other columns of
    ``docs`` are not read.
    """
    state = materialize(start_shards(docs, shards))
    for _ in range(rounds):
        state = move_round(state, shards)
    return state


def op9_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and gapless slot of every document; law ``rows``, so ``grown_shard`` is null."""
    placed = ranked(propagate(documents(spark, sf_dir).select("doc_id", "text")), ["shard"], "ord", "slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op9_label_shards": op9_label_shards}
ORACLE: dict[str, str] = {}

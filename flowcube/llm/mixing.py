"""Mixing sources to target weights by proportionate-fair (Pfair) scheduling.

Each source is cut into blocks of ``block_bytes`` in a pseudo-random order of
its documents.  Block i (from 1) of a source with target weight n/Q is
released at slot floor((i-1)Q/n) and due by slot ceil(iQ/n); in every slot the
released block with the earliest deadline runs.  As the weights sum to one,
every deadline is met, so after any number of slots each source is less than
one block away from its exact share.  Documents are not cut: one stands in the slot of the block in which it
begins, and the slots of further blocks that it fills hold no row of their own.  Counted in bytes of whole documents, after
any slot a source is therefore less than one block behind its share, and less than one block and the longest document
ahead of it.  The windows repeat every Q slots: only
one period is scheduled (a fold over Q slots on one row; Q and the number of
sources do not grow with the documents) and block b of a source takes
the slot of block b mod n in that period, shifted by (b div n) periods.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowcube.llm.common import documents, let, order_key, ranked
from flowcube.operators.materialize import materialize

#: Slots that the weights are rounded to; the period Q is the sum of the rounded weights.
PERIOD = 1000
#: UTF-8 bytes in a block.
BLOCK_BYTES = 65_536
#: Default target weight of a source: its bytes to this power (a third of the bytes becomes less).
TEMPERATURE = 0.5


def source_key(col: str = "source") -> Column:
    """Text key of a source; a null source is a source of its own."""
    return F.coalesce(F.concat(F.lit("s:"), F.col(col)), F.lit("null"))


def target_weights(sizes: DataFrame, weights: dict[str, float] | None, temperature: float, period: int) -> DataFrame:
    """(key, n, idx, q): integer weights, at least 1 each, summing to q; idx orders the sources."""
    if weights is None:
        raw = F.pow(F.greatest(F.col("bytes"), F.lit(1)).cast("double"), F.lit(temperature))
    else:
        pairs = [F.lit(x) for k, v in weights.items() for x in ("null" if k is None else f"s:{k}", float(v))]
        raw = F.coalesce(F.create_map(*pairs)[F.col("key")], F.lit(0.0)) if pairs else F.lit(1.0)
    every = Window.partitionBy(F.lit(0))
    t = sizes.withColumn("raw", raw)
    t = t.withColumn("n", F.greatest(F.lit(1), F.floor(F.col("raw") * period / F.sum("raw").over(every) + 0.5))
                     .cast("bigint"))
    return t.select("key", "n", (F.row_number().over(every.orderBy("key")) - 1).cast("int").alias("idx"),
                    F.sum("n").over(every).alias("q"))


def schedule(weights: DataFrame) -> DataFrame:
    """One period as rows (idx, nth, at): block ``nth`` of source ``idx`` runs in slot ``at``."""
    one = weights.groupBy().agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "n"))), lambda x: x["n"]).alias("ns"),
        F.sum("n").alias("q")).filter("q > 0")

    def step(acc, t):
        def best(done):
            return F.array_min(F.transform(done, lambda d, s: F.when(
                d * F.col("q") < (t + 1) * F.get(F.col("ns"), s),
                F.struct(F.ceil((d + 1) * F.col("q") / F.get(F.col("ns"), s)).alias("due"), s.alias("s")))))["s"]
        return let(best(acc["done"]), lambda pick: F.struct(
            F.transform(acc["done"], lambda d, s: F.when(s == pick, d + 1).otherwise(d)).alias("done"),
            F.concat(acc["picks"], F.array(pick)).alias("picks")))

    start = F.struct(F.transform("ns", lambda n: F.lit(0).cast("bigint")).alias("done"),
                     F.expr("cast(array() as array<int>)").alias("picks"))
    run = F.aggregate(F.sequence(F.lit(0).cast("bigint"), F.col("q") - 1), start, step, lambda acc: acc["picks"])
    slots = one.select(F.posexplode(run).alias("at", "idx"))
    order = Window.partitionBy("idx").orderBy("at")
    return slots.select("idx", (F.row_number().over(order) - 1).cast("bigint").alias("nth"),
                        F.col("at").cast("bigint").alias("at"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE,
        period: int = PERIOD, block_bytes: int = BLOCK_BYTES, size: Column | None = None, order: Column | None = None) -> DataFrame:
    """Every row of ``docs`` with ``mix_block``, ``mix_slot``, ``mix_seq`` and ``mix_exact``.

    Sorting by (mix_slot, mix_seq) interleaves the sources.  ``mix_exact`` marks the slots before
    any source runs out, where every source is less than one block (of which documents may jut out) off its target; later rows
    stay, in the slots their source would have had.  ``weights`` maps source to target weight
    (missing sources get the least weight, 1/Q); without it a source weighs bytes ** temperature.

    A document's size is its UTF-8 bytes, or ``size``; within a source documents stand in the order of the md5 of their
    doc_id, or of ``order`` (hexadecimal text, spread evenly).  Null text counts no bytes; a null source is a source of its own; rows that repeat a doc_id take
    neighbouring places in any order; an empty table gives an empty result.  Columns of ``docs`` pass
    through (a column of the same name as one added is replaced).
    """
    added = ["mix_block", "mix_slot", "mix_seq", "mix_exact"]
    size = F.octet_length("text") if size is None else size
    base = docs.select(F.struct(*[c for c in docs.columns if c not in added]).alias("__doc"), source_key().alias("__key"),
                       (order_key("doc_id") if order is None else order).alias("__order"), F.coalesce(size, F.lit(0)).cast("bigint").alias("__bytes"))
    sizes = base.groupBy(F.col("__key").alias("key")).agg(F.sum("__bytes").alias("bytes"))
    plan = materialize(target_weights(sizes, weights, temperature, period)
                       .join(sizes, "key").select("key", "idx", "n", "q", "bytes"))
    slots = materialize(schedule(plan))
    placed = ranked(base, ["__key"], "__order", "mix_seq", "__before", F.col("__bytes"))
    placed = placed.withColumn("mix_block", F.expr(f"__before div {int(block_bytes)}"))
    # first slot at which a source has no block left; the least of them ends the exact part
    blocks = F.expr(f"(bytes + {int(block_bytes)} - 1) div {int(block_bytes)}")
    ends = plan.withColumn("blocks", F.greatest(blocks, F.lit(1))).join(slots, "idx").filter(
        F.expr("nth = blocks % n")).agg(F.min(F.expr("(blocks div n) * q + at")).alias("horizon"))
    placed = placed.join(plan.select(F.col("key").alias("__key"), F.col("idx").alias("__idx"),
                                     F.col("n").alias("__n"), F.col("q").alias("__q")), "__key")
    placed = placed.withColumn("__nth", F.expr("mix_block % __n")).join(
        slots.select(F.col("idx").alias("__idx"), F.col("nth").alias("__nth"), F.col("at").alias("__at")),
        ["__idx", "__nth"])
    placed = placed.withColumn("mix_slot", F.expr("(mix_block div __n) * __q + __at"))
    placed = placed.withColumn("mix_exact", F.col("mix_slot") < ends.scalar())
    return placed.select(*[F.col("__doc").getField(c).alias(c) for c in docs.columns if c not in added], *added)


def interleave(docs: DataFrame, **options) -> DataFrame:
    """``docs`` in the order of the mix (range-partitioned by slot, so files follow one another); no row is dropped."""
    return mix(docs, **options).orderBy("mix_slot", "mix_seq").select(*docs.columns)


def op5_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mix: doc_id, source, size in bytes, block, slot, order, exact part."""
    docs = documents(spark, sf_dir).select("doc_id", "source", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("size"))
    return mix(docs, size=F.col("size")).select(
        "doc_id", "source", "size", F.col("mix_block").alias("block"), F.col("mix_slot").alias("slot"),
        F.col("mix_seq").alias("seq"), F.col("mix_exact").alias("exact"))


QUERIES = {"op5_pfair_mix": op5_pfair_mix}
ORACLE: dict[str, str] = {}

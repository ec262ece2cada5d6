"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowcube.sources.tables import table

#: Ordering buckets per key: a key holding N rows is ordered in N / 4096 sized pieces.
RANK_BUCKETS = 4096


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def let(value: Column, body) -> Column:
    """Bind ``value`` once inside a higher-order expression: ``body(v)`` may use it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def order_key(*cols) -> Column:
    """Pseudo-random, engine-independent order of rows: md5 of the identifying columns as text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("\x1f", *parts).cast("binary"))


def ranked(df: DataFrame, keys: list[str], order: str, out: str, total: str | None = None,
           amount: Column | None = None) -> DataFrame:
    """Add ``out``: the 0-based rank of each row within ``keys`` by the md5 text in ``order``.

    With ``amount`` the running sum of that column over the earlier rows is added as ``total``.
    A key may hold a third of all rows: it is cut into RANK_BUCKETS ranges of ``order``; rows are
    ranked within (key, range) and ranges get offsets from their small table of totals.  Rows that
    tie in ``order`` get distinct ranks in an arbitrary order.  Key columns must not be null.
    """
    amount = F.lit(0).cast("bigint") if amount is None else amount
    bucket = F.expr(f"cast(cast(conv(substr(`{order}`, 1, 8), 16, 10) as bigint) * {RANK_BUCKETS} "
                    "div 4294967296 as int)")
    t = df.withColumn("__bucket", bucket).withColumn("__amount", amount)
    sums = t.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__n"), F.sum("__amount").alias("__s"))
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n0"),
                          F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__s0"))
    inner = Window.partitionBy(*keys, "__bucket").orderBy(order)
    t = t.withColumn(out, F.row_number().over(inner).cast("bigint") - 1)
    if total:
        running = inner.rowsBetween(Window.unboundedPreceding, -1)
        t = t.withColumn(total, F.coalesce(F.sum("__amount").over(running), F.lit(0)))
    t = t.join(offsets, [*keys, "__bucket"]).withColumn(out, F.col(out) + F.col("__n0"))
    if total:
        t = t.withColumn(total, F.col(total) + F.col("__s0"))
    return t.drop("__bucket", "__amount", "__n0", "__s0")

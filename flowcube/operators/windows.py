"""Ordered per-key computations that stay balanced when one key is huge.

``Window.partitionBy(key)`` sends every row of a key to one task: a card or a
group holding a third of all rows would be sorted by a single task.  The
helpers here bound the work per task, by one code path for every size:

1. rows are counted per key (a map-side-combined aggregate) and the *hot* keys,
   those with more than ``bucket_rows`` rows, are written out: at most
   total_rows / bucket_rows of them;
2. hot keys get split points: quantiles of the leading order column, as many as
   the largest key needs to come down to ``bucket_rows`` rows per piece.  They are
   written once and both branches below read that copy, so a
   retried task cannot see other split points;
3. each row gets a bucket = number of its key's split points below its order
   value (0 for every other key), and the ordered computation runs per
   (key, bucket): about ``bucket_rows`` rows, unless rows tie in the leading column;
4. per-bucket totals of the hot keys (at most total_rows / bucket_rows rows for
   the largest key) give each bucket its offset.

Rows with the same leading order value always share a bucket, so ordering by
the full ``order`` list inside a bucket and by bucket across buckets is the
global order.  An empty ``keys`` list orders the whole table.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowcube.operators.materialize import materialize

BUCKET_ROWS = 4_000_000


def _numeric(df: DataFrame, col: str) -> F.Column:
    """A monotone numeric image of an orderable column (for quantiles)."""
    dtype = dict(df.dtypes)[col]
    c = F.col(col)
    if dtype.startswith("timestamp"):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast(dtype), c).cast("double")
    if dtype == "date":
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("double")
    if dtype == "string":  # the first six bytes, in byte order
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    return c.cast("double")


def _bucketed(df: DataFrame, keys: list[str], lead_col: str, bucket_rows: int) -> DataFrame:
    """``df`` with ``__bk`` (bucket) and ``__hot``; without keys every row belongs to one group."""
    d = df.withColumn("__s", _numeric(df, lead_col))
    hot = materialize(d.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > bucket_rows))
    most = hot.agg(F.max("__n")).first()[0] or bucket_rows
    splits = max(2, ceil(most / bucket_rows))
    pct = [i / splits for i in range(1, splits)]
    points = F.array_distinct(F.percentile_approx("__s", pct, max(10_000, 100 * splits))).alias("__b")
    if not keys:
        bounds = materialize(d.agg(F.count(F.lit(1)).alias("__n"), points).filter(F.col("__n") > bucket_rows)
                             .select("__b")).select("__b").scalar()
        d = d.withColumn("__b", bounds)
    else:
        bounds = materialize(d.join(hot.select(*keys), keys, "left_semi").groupBy(*keys).agg(points))
        d = d.join(bounds, keys, "left")
    bucket = F.when(F.col("__b").isNull(), F.lit(0)).otherwise(
        F.size(F.filter("__b", lambda b: b < F.col("__s"))))
    return d.withColumn("__bk", bucket).withColumn("__hot", F.col("__b").isNotNull()).drop("__b", "__s")


def _offsets(d: DataFrame, keys: list[str], measure: F.Column) -> DataFrame:
    """Sum of ``measure`` in the earlier buckets of each hot key (bounded, broadcastable)."""
    per = d.filter(F.col("__hot")).groupBy(*keys, "__bk").agg(F.sum(measure).alias("__t"))
    w = Window.partitionBy(*keys).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    return per.withColumn("__off", F.coalesce(F.sum("__t").over(w), F.lit(0))).drop("__t")


def ordinal(df: DataFrame, keys: list[str], order: list[str], out: str = "rn",
            bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """1-based position of each row within ``keys`` by ``order`` (``order`` must make rows unique).

    Same result as ``row_number().over(Window.partitionBy(keys).orderBy(order))``.
    """
    d = _bucketed(df, keys, order[0], bucket_rows)
    w = Window.partitionBy(*keys, "__bk").orderBy(*order)
    off = _offsets(d, keys, F.lit(1))
    return (d.withColumn("__local", F.row_number().over(w))
             .join(off, [*keys, "__bk"], "left")
             .withColumn(out, F.col("__local") + F.coalesce(F.col("__off"), F.lit(0)))
             .drop("__bk", "__hot", "__local", "__off"))


def ordinal_and_next(df: DataFrame, keys: list[str], order: list[str], out: str, col: str, next_out: str,
                     bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """:func:`ordinal` plus ``lead(col)`` in the same order, without a self join.

    ``lead`` runs inside each (key, bucket); the last row of a bucket takes the
    first value of the key's next bucket from the small per-bucket table.
    """
    d = _bucketed(df, keys, order[0], bucket_rows)
    w = Window.partitionBy(*keys, "__bk").orderBy(*order)
    firsts = (d.filter(F.col("__hot")).groupBy(*keys, "__bk")
               .agg(F.count(F.lit(1)).alias("__t"),
                    F.min(F.struct(*[F.col(c) for c in order], F.col(col).alias("__v"))).alias("__first")))
    wb = Window.partitionBy(*keys).orderBy("__bk")
    firsts = (firsts.withColumn("__off", F.coalesce(F.sum("__t").over(wb.rowsBetween(Window.unboundedPreceding, -1)),
                                                    F.lit(0)))
                    .withColumn("__nb", F.lead(F.col("__first.__v")).over(wb))
                    .select(*keys, "__bk", "__off", "__nb"))
    return (d.withColumn("__local", F.row_number().over(w))
             .withColumn("__lead", F.lead(col).over(w))
             .join(firsts, [*keys, "__bk"], "left")
             .withColumn(out, F.col("__local") + F.coalesce(F.col("__off"), F.lit(0)))
             .withColumn(next_out, F.coalesce(F.col("__lead"), F.col("__nb")))
             .drop("__bk", "__hot", "__local", "__off", "__lead", "__nb"))


def next_value(numbered: DataFrame, keys: list[str], rn: str, col: str, out: str) -> DataFrame:
    """``lead(col)`` by an ordinal column: an equi-join on (keys, rn + 1).

    The join key includes the ordinal, so a hot key's rows spread over many
    join partitions.
    """
    nxt = numbered.select(*keys, (F.col(rn) - 1).alias(rn), F.col(col).alias(out))
    return numbered.join(nxt, [*keys, rn], "left")


def running_sums(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, str],
                 bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Cumulative sums within ``keys`` by ``order`` (current row included); ``sums`` maps output to value column."""
    d = _bucketed(df, keys, order[0], bucket_rows)
    w = Window.partitionBy(*keys, "__bk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    per = d.filter(F.col("__hot")).groupBy(*keys, "__bk").agg(*[F.sum(v).alias(f"__t_{o}") for o, v in sums.items()])
    off = per.select(*keys, "__bk", *[F.sum(f"__t_{o}").over(before).alias(f"__off_{o}") for o in sums])
    out = d
    for o, v in sums.items():
        out = out.withColumn(f"__local_{o}", F.sum(v).over(w))
    out = out.join(off, [*keys, "__bk"], "left")
    for o in sums:
        out = out.withColumn(o, F.col(f"__local_{o}") + F.coalesce(F.col(f"__off_{o}"), F.lit(0)))
    return out.drop("__bk", "__hot", *[f"__local_{o}" for o in sums], *[f"__off_{o}" for o in sums])


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, out: str,
                bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Cumulative ``sum(value)`` within ``keys`` by ``order`` (current row included)."""
    return running_sums(df, keys, order, {out: value}, bucket_rows)

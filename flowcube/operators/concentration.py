"""Concentration of recorded work.

Inputs are member-level rows ``group cols…, person, value`` with integral values (counts, cents).
Members without a row count as zeros: ``sizes`` (group cols + ``members``) says how many members a
group has, so no zero rows are built.  Without ``sizes`` the rows are the members.

Everything works on the members counted per distinct value (a map-side-combined aggregate) and on
running sums over distinct values that split large groups, so no task holds a whole group.  A block
of c members with value v, after C members with smaller values, adds

    v · Σ(2i − n − 1) = v · c · (2C + c − n)

to the Gini numerator; G = numerator / (n · Σx).  Numerators and denominators are integers in
DECIMAL(38,0) and are divided once, so results are exact and independent of summation order (T18).

* Range given an unowned amount u: the maximum gives u to the largest holder (adds (n−1)·u).  The minimum
  raises the smallest values to a common level: block v is under the level if raising all smaller
  ones to v costs less than u (C·v − S < u, with S their sum); the first block always is.  With k members
  under it, of sum S_k, those add (S_k + u)(k − n) to the numerator.
* Floor for an integer total t over n people: r(n−r)/(n·t) with r = t mod n.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowcube.operators import windows
from flowcube.operators.materialize import materialize

EXACT = "decimal(38,0)"
#: Few-records flag (A22): a total below this.
FEW_BELOW = 14
# Upper bounds (included) and names of the bands a Gini index is shown in.
GINI_BANDS = [(0.2, "distribuído"), (0.4, "moderado"), (None, "concentrado")]


def gini_band(g: F.Column) -> F.Column:
    """Band of a Gini index; NULL where the index is absent."""
    out = F.lit(GINI_BANDS[-1][1])
    for bound, name in reversed(GINI_BANDS[:-1]):
        out = F.when(g <= bound, name).otherwise(out)
    return F.when(g.isNotNull(), out)


def exact_ratio(num: F.Column, den: F.Column) -> F.Column:
    return num.cast("double") / den.cast("double")


def _sizes(df: DataFrame, group: list[str], sizes: DataFrame | None) -> DataFrame:
    if sizes is not None:
        return sizes.select(*group, F.col("members").cast("bigint"))
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("members"))


def value_blocks(df: DataFrame, group: list[str], value: str = "value", sizes: DataFrame | None = None,
                 bucket_rows: int = windows.BUCKET_ROWS) -> DataFrame:
    """Per group and distinct value v: members c, members before, and the sum of the values before."""
    counts = df.groupBy(*group, F.col(value).cast("bigint").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    if sizes is not None:
        seen = counts.groupBy(*group).agg(F.sum("c").alias("__seen"))
        zeros = (_sizes(df, group, sizes).join(seen, group, "left")
                 .select(*group, F.lit(0).cast("bigint").alias("v"),
                         (F.col("members") - F.coalesce("__seen", F.lit(0))).alias("c")).filter(F.col("c") > 0))
        counts = counts.unionByName(zeros).groupBy(*group, "v").agg(F.sum("c").alias("c"))
    counts = materialize(counts.withColumn("amount", (F.col("v").cast("decimal(20,0)") * F.col("c")).cast(EXACT)))
    b = windows.running_sums(counts, group, ["v"], {"__c": "c", "__s": "amount"}, bucket_rows)
    return b.select(*group, "v", "c", "amount", (F.col("__c") - F.col("c")).alias("before"),
                    (F.col("__s") - F.col("amount")).cast(EXACT).alias("sum_before"))


def _weight() -> F.Column:
    """Twice the members before plus the block's own, times its amount."""
    return (F.col("amount") * (2 * F.col("before") + F.col("c")).cast("decimal(20,0)")).cast(EXACT)


def gini(df: DataFrame, group: list[str], value: str = "value", person: str = "person",
         sizes: DataFrame | None = None, blocks: DataFrame | None = None) -> DataFrame:
    """Per group: members, total, Gini, max possible Gini, largest share and holder.

    The largest holder is the lowest person id among those with the maximum
    value; groups whose total is 0 are dropped (HAVING Σx > 0).  ``blocks``: the value blocks, where they are written already.
    """
    g = ((value_blocks(df, group, value, sizes) if blocks is None else blocks).groupBy(*group)
         .agg(F.sum("c").cast("bigint").alias("members"), F.sum("amount").cast(EXACT).alias("total"),
              F.sum(_weight()).cast(EXACT).alias("__w"), F.max("v").alias("__max"),
              F.coalesce(F.sum(F.when(F.col("v") == 0, F.col("c"))), F.lit(0)).alias("members_without_record"))
         .filter(F.col("total") > 0))
    top = df.groupBy(*group).agg(F.min(F.struct((-F.col(value)).alias("v"), F.col(person).alias("p"))).alias("__top"))
    g = g.join(top, group)
    n, nt = F.col("members").cast("double"), (F.col("total") * F.col("members").cast("decimal(20,0)")).cast(EXACT)
    return g.select(
        *group, "members", F.col("total").cast("bigint").alias("total"),
        exact_ratio(F.col("__w") - nt, nt).alias("gini"),
        ((n - 1) / n).alias("gini_max"),
        (F.col("__max").cast("double") * 100 / F.col("total").cast("double")).alias("pct_largest"),
        F.col("__top.p").alias("largest_person"),
        (F.lit(100.0) / n).alias("pct_equal_split"),
        "members_without_record")


def gini_range(df: DataFrame, unowned: DataFrame, group: list[str], value: str = "value",
               person: str = "person", sizes: DataFrame | None = None, blocks: DataFrame | None = None) -> DataFrame:
    """Possible Gini range once the unowned amount ``u`` is attributed.

    ``unowned``: group cols + ``unowned`` (integral).  Output: group, members,
    total, unowned, gini_min, gini_max (NULL when total + unowned = 0).
    """
    b = (value_blocks(df, group, value, sizes) if blocks is None else blocks).join(unowned, group, "left").withColumn(
        "u", F.coalesce("unowned", F.lit(0)).cast(EXACT))
    under = (F.col("before") == 0) | ((F.col("before").cast("decimal(20,0)") * F.col("v").cast("decimal(18,0)")
                                       - F.col("sum_before")).cast(EXACT) < F.col("u"))
    g = (b.withColumn("__under", under).withColumn("__w", _weight()).groupBy(*group)
          .agg(F.sum("c").cast("bigint").alias("members"), F.sum("amount").cast(EXACT).alias("total"), F.max("u").alias("unowned"),
               F.sum("__w").cast(EXACT).alias("w"),
               F.coalesce(F.sum(F.when(~F.col("__under"), F.col("__w"))), F.lit(0)).cast(EXACT).alias("w_over"),
               F.coalesce(F.sum(F.when(~F.col("__under"), F.col("amount"))), F.lit(0)).cast(EXACT).alias("over"),
               F.sum(F.when(F.col("__under"), F.col("c"))).cast("bigint").alias("k"),
               F.sum(F.when(F.col("__under"), F.col("amount"))).cast(EXACT).alias("filled")))
    n = F.col("members").cast("decimal(20,0)")
    all_ = (F.col("total") + F.col("unowned")).cast(EXACT)
    den = (n * all_).cast(EXACT)
    low = ((F.col("filled") + F.col("unowned")).cast(EXACT) * (F.col("k") - F.col("members")).cast("decimal(20,0)")
           + F.col("w_over") - n * F.col("over"))
    high = F.col("w") - n * F.col("total") + (n - 1) * F.col("unowned")
    ok = all_ > 0
    return g.select(*group, "members", F.col("total").cast("bigint").alias("total"),
                    F.col("unowned").cast("bigint").alias("unowned"),
                    F.when(ok, exact_ratio(low, den)).alias("gini_min"),
                    F.when(ok, exact_ratio(high, den)).alias("gini_max"))


def gini_floor(df: DataFrame, group: list[str], value: str = "value", few_below: int = FEW_BELOW,
               sizes: DataFrame | None = None) -> DataFrame:
    """Lowest Gini reachable when an integer total t is split over n people (A22),
    and the few-records flag (total below ``few_below``)."""
    sums = df.groupBy(*group).agg(F.sum(F.col(value).cast(EXACT)).cast(EXACT).alias("__t"))
    g = _sizes(df, group, sizes).join(sums, group, "left").withColumn("__t", F.coalesce("__t", F.lit(0).cast(EXACT)))
    n = F.col("members").cast("decimal(20,0)")
    r = F.pmod(F.col("__t"), n)
    return g.select(*group, "members", F.col("__t").cast("bigint").alias("total"),
                    F.when(F.col("__t") > 0, exact_ratio((r * (n - r)).cast(EXACT), (n * F.col("__t")).cast(EXACT)))
                     .otherwise(F.lit(0.0)).alias("gini_floor"),
                    (F.col("__t") < few_below).alias("few_records"))


def lorenz(df: DataFrame, group: list[str], value: str = "value", person: str = "person",
           bucket_rows: int = windows.BUCKET_ROWS) -> DataFrame:
    """Lorenz points per group (A25): share of people vs cumulative share of value.

    A member's rank is the members with smaller values plus its place among those of equal value; both
    come from split running sums, so neither a large group nor one common value lands in a single task.
    """
    rows = materialize(df.select(*group, person, F.col(value).cast("bigint").alias("v")))
    blocks = value_blocks(rows, group, "v", bucket_rows=bucket_rows).select(*group, "v", "before", "sum_before")
    whole = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"), F.sum(F.col("v").cast(EXACT)).cast(EXACT).alias("__t"))
    r = windows.ordinal(rows, [*group, "v"], [person], "__k", bucket_rows).join(blocks, [*group, "v"]).join(whole, group)
    pre = (F.col("sum_before") + F.col("v").cast("decimal(20,0)") * F.col("__k").cast("decimal(18,0)")).cast(EXACT)
    return r.select(*group, (F.col("before") + F.col("__k")).cast("int").alias("i"), person,
                    ((F.col("before") + F.col("__k")).cast("double") / F.col("__n").cast("double")).alias("p_people"),
                    F.try_divide(pre.cast("double"), F.col("__t").cast("double")).alias("p_value"))


def top_k_share(df: DataFrame, group: list[str], value: str = "value", person: str = "person",
                k: int = 2) -> DataFrame:
    """Total, holders (value > 0), the k largest values and their share.

    The totals are a map-side-combined aggregate; the window only sees k rows per group and task, as
    Spark limits a filtered ``row_number`` before its shuffle.
    """
    w = Window.partitionBy(*group).orderBy(F.col(value).desc(), F.col(person).asc())
    first = df.withColumn("__rk", F.row_number().over(w)).filter(F.col("__rk") <= k)
    tops = first.groupBy(*group).agg(F.sum(value).alias("top_total"), *[
        F.max(F.when(F.col("__rk") == j, F.col(value))).alias(f"top{j}") for j in range(1, k + 1)])
    sums = df.groupBy(*group).agg(F.sum(value).alias("total"), F.count_if(F.col(value) > 0).alias("holders"))
    return sums.join(tops, group)

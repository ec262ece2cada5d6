"""Planned against actual duration.

Canonical inputs: ``cards`` team, card, sprint, created_at, closed_at, size
(NULL when unsized); ``sizes`` size, size_order, planned_days; ``links``
team, card, commit_id, author_id, lines (valid, non-dangling citations).

Medians are exact (the average of the two middle values), computed by
:func:`exact_median`, which never gathers a group's raw values in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowcube.functions.timecalc import MICROS_PER_DAY, elapsed_micros
from flowcube.operators import windows
from flowcube.operators.materialize import materialize

# Ratio bands and the unsized bucket.
BAND_WITHIN = "dentro do planejado"
BAND_DOUBLE = "até o dobro"
BAND_OVER = "mais que o dobro"
NO_SIZE = "(sem tamanho)"


def exact_median(df: DataFrame, group: list[str], value: str, out: str = "median") -> DataFrame:
    """Exact median per group: mean of the values at positions ⌊(n+1)/2⌋ and ⌊(n+2)/2⌋.

    Values are first counted per (group, value) — a map-side-combined
    aggregate — and the cumulative counts run over distinct values only,
    with the skew-tolerant running sum (a group with many distinct values is
    split over several tasks).  NULL values are ignored.
    """
    c = materialize(df.filter(F.col(value).isNotNull()).groupBy(*group, value)
                      .agg(F.count(F.lit(1)).alias("__c")))
    c = windows.running_sum(c, group, [value], "__c", "__cum")
    n = c.groupBy(*group).agg(F.sum("__c").alias("__n"))
    c = c.join(n, group)
    k1 = F.floor((F.col("__n") + 1) / 2)
    k2 = F.floor((F.col("__n") + 2) / 2)
    prev = F.col("__cum") - F.col("__c")
    hit1 = (prev < k1) & (k1 <= F.col("__cum"))
    hit2 = (prev < k2) & (k2 <= F.col("__cum"))
    return (c.groupBy(*group)
             .agg(F.max(F.when(hit1, F.col(value))).alias("__v1"), F.max(F.when(hit2, F.col(value))).alias("__v2"))
             .select(*group, ((F.col("__v1").cast("double") + F.col("__v2").cast("double")) / 2).alias(out)))


def exact_medians(df: DataFrame, group: list[str], values: dict[str, str]) -> DataFrame:
    """:func:`exact_median` of several columns at once (output -> column): one table of counted values with the measure as a further key."""
    rows = df.select(*group, F.explode(F.array(*[F.struct(F.lit(out).alias("__of"), F.col(c).cast("double").alias("__v")) for out, c in values.items()])).alias("__x"))
    m = exact_median(rows.select(*group, "__x.*"), [*group, "__of"], "__v", "__m")
    return m.groupBy(*group).agg(*[F.max(F.when(F.col("__of") == out, F.col("__m"))).alias(out) for out in values])


def link_stats(links: DataFrame) -> DataFrame:
    return links.groupBy("team", "card").agg(F.count(F.lit(1)).alias("linked_commits"),
                                             F.countDistinct("author_id").alias("distinct_authors"),
                                             F.sum("lines").cast("bigint").alias("changed_lines"))


def card_base(cards: DataFrame, sizes: DataFrame, links: DataFrame) -> DataFrame:
    """Every card with size, planned days, actual days (exact), ratio and commit stats.

    ``sizes`` is a fixed table of a few rows and is broadcast: cards are never dealt out by their size.
    """
    c = (cards.join(F.broadcast(sizes), "size", "left")
              .join(link_stats(links), ["team", "card"], "left"))
    micros = elapsed_micros("created_at", "closed_at")
    days = micros.cast("double") / F.lit(float(MICROS_PER_DAY))
    return (c.withColumn("actual_days", F.when(F.col("closed_at").isNotNull(), days))
             .withColumn("ratio", F.col("actual_days") / F.col("planned_days"))
             .withColumn("in_chart", F.col("closed_at").isNotNull() & F.col("planned_days").isNotNull())
             .withColumn("linked_commits", F.coalesce("linked_commits", F.lit(0)).cast("bigint"))
             .withColumn("distinct_authors", F.coalesce("distinct_authors", F.lit(0)).cast("bigint"))
             .withColumn("changed_lines", F.coalesce("changed_lines", F.lit(0)).cast("bigint")))


def band(ratio: F.Column, over: float = 1.0, double: float = 2.0) -> F.Column:
    return F.when(ratio <= over, BAND_WITHIN).when(ratio <= double, BAND_DOUBLE).otherwise(BAND_OVER)


def planned_vs_actual(base: DataFrame, over: float = 1.0, double: float = 2.0) -> DataFrame:
    """Closed, sized cards with ratio and band (M10); bands use the exact ratio."""
    return (base.filter(F.col("in_chart"))
                .select("team", "card", "sprint", "size", "size_order", "planned_days", "created_at", "closed_at",
                        "actual_days", "ratio", band(F.col("ratio"), over, double).alias("band"),
                        "linked_commits", "distinct_authors", "changed_lines"))


def size_summary(base: DataFrame) -> DataFrame:
    """Per team and size, plus the unsized row (M11): counts in/out of the chart,
    exact medians, shares over plan / over double, commits."""
    b = base.withColumn("size", F.coalesce("size", F.lit(NO_SIZE)))
    chart = b.filter(F.col("in_chart"))
    medians = exact_medians(chart, ["team", "size"], {"median_actual_days": "actual_days", "median_commits": "linked_commits"})
    inc = F.col("in_chart")
    g = b.groupBy("team", "size").agg(
        F.max("planned_days").alias("planned_days"), F.count(F.lit(1)).alias("cards"),
        F.count_if(inc).alias("in_chart"),
        F.count_if(inc & (F.col("actual_days") > F.col("planned_days"))).alias("__over"),
        F.count_if(inc & (F.col("actual_days") > 2 * F.col("planned_days"))).alias("__dbl"),
        F.sum(F.when(inc, F.col("linked_commits")).otherwise(0)).cast("bigint").alias("linked_commits"),
        F.count_if(inc & (F.col("linked_commits") == 0)).alias("cards_without_commit"))
    pct = lambda c: F.try_divide(F.col(c).cast("double") * 100, F.col("in_chart").cast("double"))
    return (g.join(medians, ["team", "size"], "left")
             .select("team", "size", "planned_days", "cards", "in_chart",
                     (F.col("cards") - F.col("in_chart")).alias("out_of_chart"), "median_actual_days",
                     (F.col("median_actual_days") / F.col("planned_days")).alias("median_ratio"),
                     pct("__over").alias("pct_over_plan"), pct("__dbl").alias("pct_over_double"),
                     "median_commits", "linked_commits", "cards_without_commit"))


def ratio_summary(pva: DataFrame) -> DataFrame:
    """Per team (M12): cards, over plan, over double, their share, median ratio."""
    g = pva.groupBy("team").agg(F.count(F.lit(1)).alias("cards"),
                                F.count_if(F.col("actual_days") > F.col("planned_days")).alias("over_plan"),
                                F.count_if(F.col("actual_days") > 2 * F.col("planned_days")).alias("over_double"))
    m = exact_median(pva, ["team"], "ratio", "median_ratio")
    return g.join(m, "team").select("team", "cards", "over_plan", "over_double",
                                    (F.col("over_plan").cast("double") * 100 / F.col("cards").cast("double"))
                                    .alias("pct_over_plan"), "median_ratio")


def ratio_outliers(pva: DataFrame, n: int = 3, min_ratio: float = 2.0) -> DataFrame:
    """Up to n cards per team with the largest ratio above ``min_ratio``."""
    w = Window.partitionBy("team").orderBy(F.col("ratio").desc(), F.col("card").asc())
    return (pva.filter(F.col("ratio") > min_ratio).withColumn("rank", F.row_number().over(w))
               .filter(F.col("rank") <= n).select("team", "rank", "card", "size", "actual_days", "ratio"))

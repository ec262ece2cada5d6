"""Slices (team × period) and member grids.

A record counts in its own period *and* in the all-periods slice; a record
without a period counts only in the all-periods slice (T12).  The slice names
are exploded from a one- or two-element array before any join, so one plan
serves both levels and no GROUPING SETS NULL slice appears.

Scale notes: grids are |slices| × |members of the team| — bounded by the
roster, not by the record volume.  Records are aggregated to
(team, slice, measure, person) before they meet the grid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Slice and bucket labels of the reference.
ALL_SLICE = "(todas)"
NO_SPRINT = "(sem sprint)"
UNOWNED = "(não atribuído)"
EMPTY_OWNER = "(vazio)"
GROUP_ROW = "(grupo)"


def slice_explode(df: DataFrame, period: str = "sprint", all_label: str = ALL_SLICE,
                  out: str = "slice") -> DataFrame:
    """Each row once per slice: its period (when it has one) and ``all_label``."""
    has = F.col(period).isNotNull() & (F.col(period) != NO_SPRINT)
    slices = F.when(has, F.array(F.lit(all_label), F.col(period))).otherwise(F.array(F.lit(all_label)))
    return df.withColumn(out, F.explode(slices))


def classify_owner(records: DataFrame, members: DataFrame, person: str = "person") -> DataFrame:
    """Owner kept when a member of the record's team, else the unowned bucket."""
    m = members.select("team", F.col("person").alias("__m"))
    # The roster is not size-bounded (it grows with the people tracked), so the
    # join strategy is left to AQE's size check rather than forced to broadcast.
    j = records.join(m, (records["team"] == m["team"]) & (records[person] == m["__m"]), "left") \
               .drop(m["team"])
    return j.withColumn(person, F.when(F.col("__m").isNotNull(), F.col(person)).otherwise(F.lit(UNOWNED))) \
            .drop("__m")


def slice_totals(records: DataFrame, members: DataFrame, reduced: bool = False) -> DataFrame:
    """Value per team × slice × measure × person that has records, non-members under the unowned label.

    ``records``: team, sprint, person, measure, value (integral).  ``members``: team, person.
    ``reduced``: the records are already unique per (team, sprint, person, measure).
    """
    # The record volume is reduced here once; every later step reads this
    # aggregate (slices, owner classification).  Records that are already
    # reduced (and written) skip it: it would add a shuffle per reader.
    pre = records if reduced else \
        records.groupBy("team", "sprint", "person", "measure").agg(F.sum("value").alias("value"))
    return (classify_owner(slice_explode(pre), members)
            .groupBy("team", "slice", "measure", "person").agg(F.sum("value").cast("bigint").alias("value")))


def slice_sizes(totals: DataFrame, members: DataFrame) -> DataFrame:
    """Every slice with its number of members (also slices in which only non-members have records)."""
    n = members.groupBy("team").agg(F.count(F.lit(1)).alias("members"))
    return totals.select("team", "slice", "measure").distinct().join(n, "team")


def contribution(totals: DataFrame, members: DataFrame) -> DataFrame:
    """``slice_totals`` on the grid of slices and members, zeros kept, unowned row per slice.

    Output: team, slice, measure, person, is_member, value, pct_of_members.
    """
    slices = totals.select("team", "slice", "measure").distinct()
    grid = (slices.join(members.select("team", "person"), "team").withColumn("is_member", F.lit(1))
            .unionByName(slices.withColumn("person", F.lit(UNOWNED)).withColumn("is_member", F.lit(0))))
    owned = (totals.filter(F.col("person") != UNOWNED).groupBy("team", "slice", "measure")
             .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("__tot")))
    g = (grid.join(totals, ["team", "slice", "measure", "person"], "left")
             .join(owned, ["team", "slice", "measure"], "left")
             .withColumn("value", F.coalesce("value", F.lit(0)).cast("bigint")))
    return g.select("team", "slice", "measure", "person", "is_member", "value",
                    F.try_divide(F.col("value").cast("double") * 100, F.col("__tot").cast("double"))
                     .alias("pct_of_members"))


def weight_units(n_col: F.Column, lcm: int) -> F.Column:
    """1/n expressed in exact integer units of 1/lcm (n divides lcm)."""
    return (F.lit(lcm) / n_col).cast("bigint")

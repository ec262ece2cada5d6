"""Figures counted a second way (Q13), by algorithms that share no step with the first.

* :func:`order_statistics`: the k-th smallest value of a group by bisection on counts, DIGIT bits at a
  time: a pass counts the rows per digit below the prefix found so far and picks the digit in which the k-th row lies.
  The first way (``planning.exact_median``) sorts distinct values and sums counts over windows.
* :func:`largest`: the k largest values per group as a mergeable aggregate whose state is a sorted list of k values: every
  task folds its rows into one state per group, states of a group are then merged.  The first way ranks rows by a window.
* :func:`pair_differences`: sum of |x - y| over all pairs of a group, from runs of neighbouring values.  A run
  is (c members, sum s, sum d of differences inside); of two runs, one above the other, the pair is (c + c', s + s', d + d' + s'c - sc').
  Runs are merged along the digits of the value, at most 2^DIGIT per step.  The first way weighs ranks.

No group is held or sorted by one task: passes are map-side-combined aggregates over at most 2^DIGIT
rows per group and prefix.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import nlargest

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowcube.operators.materialize import materialize

#: Bits of a value that one pass decides.
DIGIT = 12
EXACT = "decimal(38,0)"


def _digits(most: int | None) -> int:
    return max(1, -(-int(most or 0).bit_length() // DIGIT))


def order_statistics(df: DataFrame, group: list[str], value: str, places: dict[str, F.Column]) -> DataFrame:
    """Per group the values at 1-based ``places`` (expressions over the group's row count ``n``); NULL values are ignored.

    ``value`` must be integral.  Output: group and one bigint column per place.
    """
    rows = materialize(df.filter(F.col(value).isNotNull()).select(*group, F.col(value).cast("bigint").alias("v")))
    span = materialize(rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")))
    most = span.agg(F.max(F.col("high") - F.col("low"))).first()[0]
    targets = F.explode(F.array(*[F.struct(F.lit(name).alias("place"), at.cast("bigint").alias("k")) for name, at in places.items()]))
    state = span.select(*group, "low", targets.alias("t")).select(
        *group, "low", "t.place", "t.k", F.lit(0).cast("bigint").alias("prefix"))
    for level in reversed(range(_digits(most))):
        shift = level * DIGIT
        at = F.col("v") - F.col("low")
        per = (rows.join(state, group).filter(F.shiftright(at, shift + DIGIT) == F.col("prefix"))
               .withColumn("digit", F.shiftright(at, shift).bitwiseAND(F.lit((1 << DIGIT) - 1)))
               .groupBy(*group, "place", "low", "prefix", "k", "digit").agg(F.count(F.lit(1)).alias("c")))
        upto = F.sum("c").over(Window.partitionBy(*group, "place").orderBy("digit"))
        hit = per.withColumn("upto", upto).filter((F.col("upto") >= F.col("k")) & (F.col("upto") - F.col("c") < F.col("k")))
        state = materialize(hit.select(*group, "low", "place", (F.col("k") - F.col("upto") + F.col("c")).alias("k"),
                                       (F.col("prefix") * (1 << DIGIT) + F.col("digit")).alias("prefix")))
    return state.groupBy(*group).agg(*[
        F.max(F.when(F.col("place") == name, F.col("low") + F.col("prefix"))).alias(name) for name in places])


def middle(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """The two middle values of each group, ``low_middle`` and ``high_middle`` (equal for an odd number of rows)."""
    return order_statistics(df, group, value, {"low_middle": F.expr("(n + 1) div 2"), "high_middle": F.expr("(n + 2) div 2")})


def largest(df: DataFrame, group: list[str], value: str, k: int, out: str = "largest") -> DataFrame:
    """Per group the ``k`` largest values, descending, as an array of bigint; NULL values are ignored."""
    rows = df.filter(F.col(value).isNotNull()).select(*group, F.array(F.col(value).cast("bigint")).alias(out))

    def fold(batches: Iterator) -> Iterator:
        import pandas as pd
        states: dict[tuple, list[int]] = {}
        for batch in batches:
            for *key, values in batch.itertuples(index=False, name=None):
                states[tuple(key)] = nlargest(k, [*states.get(tuple(key), ()), *(int(v) for v in values)])
        if states:
            yield pd.DataFrame([[*key, state] for key, state in states.items()], columns=[*group, out])

    states = rows.mapInPandas(fold, rows.schema)
    return states.repartition(*group).mapInPandas(fold, rows.schema)


def pair_differences(df: DataFrame, group: list[str], value: str, sizes: DataFrame | None = None) -> DataFrame:
    """Per group: members, total and ``differences``, the sum of |x - y| over all pairs of its values (integral, not negative).

    ``sizes`` (group and ``members``) adds members without a row, with value zero.
    """
    runs = df.groupBy(*group, F.col(value).cast("bigint").alias("p")).agg(F.count(F.lit(1)).alias("c"))
    if sizes is not None:
        seen = runs.groupBy(*group).agg(F.sum("c").alias("seen"))
        absent = sizes.join(seen, group, "left").select(
            *group, F.lit(0).cast("bigint").alias("p"), (F.col("members") - F.coalesce("seen", F.lit(0))).cast("bigint").alias("c"))
        runs = runs.unionByName(absent.filter("c > 0")).groupBy(*group, "p").agg(F.sum("c").alias("c"))
    runs = materialize(runs.select(*group, "p", F.col("c").cast(EXACT).alias("c"),
                                   (F.col("p").cast("decimal(20,0)") * F.col("c")).cast(EXACT).alias("s"), F.lit(0).cast(EXACT).alias("d")))
    most = runs.agg(F.max("p")).first()[0]
    zero = F.lit(0).cast(EXACT)
    for _ in range(_digits(most)):
        ordered = F.sort_array(F.collect_list(F.struct("p", "c", "s", "d")))  # at most 2^DIGIT runs
        merged = F.aggregate("runs", F.struct(zero.alias("c"), zero.alias("s"), zero.alias("d")), lambda a, x: F.struct(
            (a["c"] + x["c"]).cast(EXACT).alias("c"), (a["s"] + x["s"]).cast(EXACT).alias("s"),
            (a["d"] + x["d"] + (x["s"] * a["c"]).cast(EXACT) - (a["s"] * x["c"]).cast(EXACT)).cast(EXACT).alias("d")))
        runs = (runs.groupBy(*group, F.shiftright("p", DIGIT).alias("up")).agg(ordered.alias("runs"))
                .select(*group, F.col("up").alias("p"), merged.alias("m")).select(*group, "p", "m.c", "m.s", "m.d"))
    return runs.select(*group, F.col("c").cast("bigint").alias("members"), F.col("s").alias("total"), F.col("d").alias("differences"))


def differing(first: DataFrame, second: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """One row: in ``out``, the keys whose ``value`` differs between two counts, those that one count lacks included."""
    a = first.select(*keys, F.struct(F.col(value).alias("v")).alias("__a"))
    b = second.select(*keys, F.struct(F.col(value).alias("v")).alias("__b"))
    return a.join(b, keys, "full").agg(F.count_if(~F.col("__a").eqNullSafe(F.col("__b"))).alias(out))

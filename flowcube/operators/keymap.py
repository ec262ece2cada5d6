"""Stable surrogate keys (D9): an append-only map from natural to surrogate keys.

A load adds the natural keys that the map lacks (an anti join) with the ordinals after its last key, as one published
version; nothing that was published changes.  A member that appears later, whatever its place in the order of
the others, shifts no key, and a member that disappears keeps its own.  Facts get their keys by joining the map.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowcube.operators import windows
from flowcube.sources import published


def read_keys(spark: SparkSession, root: str) -> DataFrame | None:
    """The published map (natural key columns and ``sk``); None before the first load."""
    parts = [spark.read.parquet(f"{v.folder}/keys") for v in published.versions(spark, root)]
    return reduce(DataFrame.unionByName, parts) if parts else None


def extend(members: DataFrame, natural: list[str], order: list[str], root: str, mark: str) -> DataFrame:
    """The map under ``root`` with a key for every distinct ``natural`` key of ``members``, new ones in ``order``.

    ``mark`` names the state of the inputs: a state that has been loaded is not loaded again.  ``order`` must be unique.
    """
    spark = members.sparkSession
    while not any(v.fingerprint == mark for v in published.versions(spark, root)):
        try:
            _load(members, natural, order, root, mark)
        except published.Taken:  # another loader's keys come first: number the rest after them
            continue
    return read_keys(spark, root)


def _load(members: DataFrame, natural: list[str], order: list[str], root: str, mark: str) -> None:
    spark = members.sparkSession
    known = read_keys(spark, root)
    # other columns of the order come along: the least per natural key
    extra = [c for c in order if c not in natural]
    new = members.groupBy(*natural).agg(*[F.min(c).alias(c) for c in extra]) if extra else members.select(*natural).distinct()
    last = 0
    if known is not None:
        new = new.join(known.select(*natural), natural, "left_anti")
        last = known.agg(F.max("sk")).first()[0] or 0
    keyed = windows.ordinal(new, [], order, "sk").select(*natural, (F.col("sk") + last).cast("bigint").alias("sk"))

    def write(folder: str) -> DataFrame:
        keyed.write.parquet(f"{folder}/keys")
        mine = spark.read.parquet(f"{folder}/keys")
        one = mine.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.struct(*natural)).alias("naturals"),
                       F.coalesce(F.max("sk") - F.lit(last), F.lit(0)).alias("span"), F.countDistinct("sk").alias("keys"))
        rows = ", ".join(f"'{g}', CAST({a} AS STRING), CAST(n AS STRING)" for g, a in
                         [("new_keys_dense", "span"), ("new_keys_distinct", "keys"), ("new_members_distinct", "naturals")])
        return one.selectExpr(f"stack(3, {rows}) AS (gate, observed, expected)").withColumn("ok", F.col("observed") == F.col("expected"))

    published.publish(spark, root, mark, write)

"""Field-coverage matrix and alerts.

A coverage measure names a file and a field, the rows it counts and those of them that are filled, as
conditions on one base table.  All measures of a base table come from one grouped aggregate, which is
then unpivoted; the tables' results are stacked with ``unionByName``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Measure:
    file: str
    field: str
    filled: Column  # condition
    screens: str
    effect: str
    rows: Column | None = None  # condition; all rows without one


def coverage(tables: list[tuple[DataFrame, list[Measure]]]) -> DataFrame:
    """team, file, field, records, filled, empty, pct, effect, screens (M7), one scan per base table."""
    parts = []
    for df, measures in tables:
        aggs = []
        for i, m in enumerate(measures):
            of = F.lit(True) if m.rows is None else m.rows
            aggs += [F.count_if(of).alias(f"n{i}"), F.count_if(of & m.filled).alias(f"f{i}")]
        rows = F.array(*[F.struct(F.lit(m.file).alias("file"), F.lit(m.field).alias("field"), F.col(f"n{i}").alias("records"),
                                  F.col(f"f{i}").alias("filled"), F.lit(m.effect).alias("effect"), F.lit(m.screens).alias("screens"))
                         for i, m in enumerate(measures)])
        parts.append(df.groupBy("team").agg(*aggs).select("team", F.explode(rows).alias("m")).select("team", "m.*").filter("records > 0"))
    r = reduce(lambda a, b: a.unionByName(b), parts)
    return r.select("team", "file", "field", "records", "filled", (F.col("records") - F.col("filled")).alias("empty"),
                    F.try_divide(F.col("filled").cast("double") * 100, F.col("records").cast("double")).alias("pct"),
                    "effect", "screens")


def coverage_alerts(cov: DataFrame, min_pct: float = 80.0) -> DataFrame:
    """Per team: fields below ``min_pct``, their names, the screens they affect (M8).

    Lists are built from the coverage rows of one team, which the number of
    measured fields bounds.
    """
    below = cov.filter(F.col("pct") < min_pct)
    screens = below.select("team", F.explode(F.split("screens", r",\s*")).alias("screen"))
    s = screens.groupBy("team").agg(F.concat_ws(", ", F.array_sort(F.collect_set("screen"))).alias("screens"))
    f = below.groupBy("team").agg(
        F.count(F.lit(1)).alias("fields_below"),
        F.concat_ws("; ", F.array_sort(F.collect_list(F.concat_ws("/", "file", "field")))).alias("fields"),
        F.min("pct").alias("worst_pct"))
    teams = cov.select("team").distinct()
    return (teams.join(f, "team", "left").join(s, "team", "left")
                 .select("team", F.coalesce("fields_below", F.lit(0)).cast("bigint").alias("fields_below"),
                         "fields", "worst_pct", "screens"))


def worst_by_field(cov: DataFrame) -> DataFrame:
    """Lowest coverage of each field over the teams."""
    return cov.groupBy("file", "field").agg(F.min("pct").alias("worst_pct"))

"""One-row aggregates used as values.

A global aggregate (``df.agg(...)`` without grouping) has exactly one row.
Its values are attached to other rows as uncorrelated scalar subqueries
(``DataFrame.scalar()``): Spark runs each subquery once and reuses the
result, so no join of any kind is planned and nothing reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def values_of(one_row: DataFrame) -> list[F.Column]:
    """The columns of a one-row aggregate as scalar values, under their names.

    The row is taken as one struct, so the aggregate runs once however many
    columns are read from it.
    """
    s = one_row.select(F.struct(*one_row.columns).alias("__row")).scalar()
    return [s.getField(c).alias(c) for c in one_row.columns]


def side_by_side(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Columns of several one-row aggregates in one row."""
    cols = [F.col(c) for c in first.columns]
    for o in others:
        cols += values_of(o)
    return first.select(*cols)

"""Materialise the star layer: item fact and additive mart, partitioned by month, published when every gate is true.

Reports read the written layer instead of deriving the four-table fact again.  A build goes under a folder of its
own in the shared checkpoint folder, is audited there, and is published in the log of ``sources.published`` under the fingerprint of its
inputs: a false gate raises and the layer before stays; changed inputs build a new version.  Writing also
cuts the lineage: a lost executor never forces the fact joins to be recomputed for a report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowcube.functions.scalars import side_by_side
from flowcube.operators import olap, quality
from flowcube.plans import olap as olap_plan
from flowcube.sources import io, published
from flowcube.sources.tables import Tables

#: Tables that the star layer is derived from.
INPUTS = ["lineitem", "orders", "customer", "nation", "part"]
#: Versions that this application has read, so that a report looks at the inputs and not at the log.
_READ: dict[tuple[str, str, str], dict[str, str]] = {}


def star_layer(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(fact, mart) of the published star layer of ``sf_dir`` as its files are now; built if there is none."""
    mark = published.fingerprint(spark, [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in INPUTS])
    key = (spark.sparkContext.applicationId, sf_dir, mark)
    if key not in _READ:
        root = published.root_of(spark, "star", sf_dir)
        _READ[key] = _paths(published.derived(spark, root, mark, lambda folder: build_star(spark, sf_dir, folder)))
    paths = _READ[key]
    return (spark.read.parquet(paths["fact_item"]).select(*olap.FACT_COLUMNS),
            spark.read.parquet(paths["mart_monthly"]).select(*olap.MART_COLUMNS))


def _paths(folder: str) -> dict[str, str]:
    return {name: f"{folder}/{name}" for name in ("fact_item", "mart_monthly", "gates")}


def build_star(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Write fact_item and mart_monthly (partitioned by month) under ``folder``; return their gates."""
    t, paths = Tables(spark, sf_dir), _paths(folder)
    # months are brought together before the write, large ones in several tasks: a few files a month
    io.write_table(olap_plan.fact(t).hint("rebalance", "month"), paths["fact_item"], ["month"])
    fact = spark.read.parquet(paths["fact_item"])
    io.write_table(olap.monthly_mart(fact).hint("rebalance", "month"), paths["mart_monthly"], ["month"])
    mart = spark.read.parquet(paths["mart_monthly"]).select(*olap.MART_COLUMNS)
    items = olap_plan.items(t)
    one = side_by_side(items.agg(olap.money_sum("price").alias("src_rev"), F.count(F.lit(1)).alias("src_rows")),
                       fact.agg(olap.money_sum("price").alias("fact_rev"), F.count(F.lit(1)).alias("fact_rows")),
                       mart.agg(F.sum("product_revenue").cast(olap.MONEY_SUM).alias("mart_rev"),
                                F.sum("items").cast("bigint").alias("mart_rows")))
    return quality.gate_rows(one, [("fact_rows_eq_source", "fact_rows", "src_rows"),
                                   ("fact_revenue_eq_source", "fact_rev", "src_rev"),
                                   ("mart_revenue_eq_fact", "mart_rev", "fact_rev"),
                                   ("mart_items_eq_fact", "mart_rows", "fact_rows")])

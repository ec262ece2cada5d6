"""Materialising intermediates that several branches of a plan consume.

Spark re-derives a DataFrame for every branch that reads it unless the
branches happen to share an identical exchange; branches that prune
different columns do not.  An intermediate read several times (a deduped
event log, a contribution table, per-value counts) is therefore written once
as a Parquet table in the shared folder named by ``spark.checkpoint.dir`` and
read back.  That also cuts the lineage: after an executor loss, tasks re-read
the written table instead of recomputing the upstream joins.

A written table is preferred over ``Dataset.checkpoint()``: an eager
reliable checkpoint runs its input twice (a count, then the checkpoint
write), while a write is one job, and the Parquet copy is columnar, so each
reader scans only the columns it needs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from flowcube.session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once under the checkpoint folder and return a DataFrame reading it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/materialized/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)

"""Write, audit, publish: versions of derived tables that readers only see whole and audited.

A version is a folder under a root.  It is written first, audited where it lies, and becomes visible by one small entry in
the root's log: number, folder, and the fingerprint of the inputs that it was derived from.  Readers go by the log alone, so a build that
fails, is lost half-way or does not pass its gates leaves the last version as it was.  Versions are never changed.

Two loaders may derive the same version at once: the entry of a number is made by one of them, the other finds it and takes the
published version, or, if it was derived from something else, starts again after it.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable
from functools import lru_cache
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from flowcube.session import ensure_checkpoint_dir

#: Seconds after which an entry that is begun and not written is taken for abandoned.
ABANDONED_S = 30
LOG = "number bigint, folder string, fingerprint string"


class Taken(RuntimeError):
    """Another loader published something else meanwhile; what was derived from the versions before is out of date."""


class GateError(RuntimeError):
    """A version did not pass its gates; it is not published."""


def root_of(spark: SparkSession, kind: str, source: str) -> str:
    """Folder of the versions of ``kind`` derived from ``source``, in the shared checkpoint folder."""
    name = hashlib.sha256(source.rstrip("/").encode()).hexdigest()[:16]
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}/{name}"


@lru_cache(maxsize=1)
def definitions() -> str:
    """A digest of this library's modules: what a version is derived by.  A shared folder outlives a release."""
    package = Path(__file__).resolve().parents[1]
    code = hashlib.sha256()
    for path in sorted(p for part in ("functions", "operators", "plans", "sources") for p in (package / part).glob("*.py")):
        code.update(path.read_bytes())
    return code.hexdigest()[:16]


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """What a version is derived from: a digest of path, length and modification time of all Parquet files under ``paths``
    (no file is read), and of the definitions."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
             .load(paths).select("path", "length", "modificationTime"))
    one = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"),
                    F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("h")).first()
    return f"{one.n}-{one.bytes or 0}-{one.h or 0}-{definitions()}"


def versions(spark: SparkSession, root: str) -> list[Row]:
    """Published versions, oldest first."""
    try:
        return sorted(spark.read.schema(LOG).json(f"{root}/_log/*").collect(), key=lambda r: r.number)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def publish(spark: SparkSession, root: str, mark: str, write: Callable[[str], DataFrame | None]) -> Row:
    """Write a new version by ``write(folder)`` and publish it if every row of the gates that it returns is ok.

    Gates are written beside the version (``gates``, JSON), published or not.
    """
    number = max((v.number for v in versions(spark, root)), default=0) + 1
    folder = f"{root}/{number:06d}-{uuid.uuid4().hex}"
    gates = write(folder)
    if gates is not None:
        gates.write.json(f"{folder}/gates")
        failed = spark.read.schema(gates.schema).json(f"{folder}/gates").filter(~F.coalesce("ok", F.lit(False))).collect()
        if failed:
            raise GateError("; ".join(f"{r.gate}: {r.observed} instead of {r.expected}" for r in failed))
    entry = spark.createDataFrame([(number, folder, mark)], LOG).coalesce(1)
    for _ in range(ABANDONED_S):
        try:
            entry.write.mode("errorifexists").json(f"{root}/_log/{number:06d}")
            return Row(number=number, folder=folder, fingerprint=mark)
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
        others = [v for v in versions(spark, root) if v.number >= number]
        if any(v.fingerprint == mark for v in others):
            return next(v for v in others if v.fingerprint == mark)
        if others:
            raise Taken(root)
        time.sleep(1)  # another loader is writing the entry
    entry.write.mode("overwrite").json(f"{root}/_log/{number:06d}")  # its loader was lost before it was written
    return Row(number=number, folder=folder, fingerprint=mark)


def derived(spark: SparkSession, root: str, mark: str, write: Callable[[str], DataFrame | None]) -> str:
    """Folder of the version derived from inputs of fingerprint ``mark``, written and published if there is none."""
    while True:
        same = [v for v in versions(spark, root) if v.fingerprint == mark]
        if same:
            return same[-1].folder
        try:
            return publish(spark, root, mark, write).folder
        except Taken:
            continue

"""Typed readers, raw-input audits and sinks.

The reading path always uses an explicit schema.  Content-based type
inference is kept as a *profiling job* over raw text columns
(:func:`infer_types`), never as the read path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns of the reference's content inference (integer, real,
# ISO date, ISO timestamp with offset, timestamp-looking text without offset).
RE_INT = r"^-?\d+$"
RE_REAL = r"^-?\d+\.\d+$"
RE_DATE = r"^\d{4}-\d{2}-\d{2}$"
RE_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
RE_TIMESTAMP_NO_ZONE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """CSV with quoted line breaks, CRLF and an optional BOM; empty field -> NULL.

    ``enforceSchema=false`` makes Spark check the header against the schema;
    FAILFAST stops on short/overflowing rows instead of padding silently.
    Multi-line CSV is not splittable: convert it once to Parquet.
    """
    return (spark.read.schema(schema)
            .option("header", True).option("enforceSchema", False)
            .option("multiLine", True).option("quote", '"').option("escape", '"')
            .option("sep", sep).option("nullValue", "").option("emptyValue", None)
            .option("mode", "FAILFAST").option("encoding", "UTF-8")
            .csv(path))


def to_local_wall_time(col: str | F.Column, zone: str = "America/Sao_Paulo") -> F.Column:
    """ISO instant text with ``Z``/``±hh:mm`` -> local wall-clock timestamp without zone.

    The parsed instant is rendered in the session zone and then moved to
    ``zone``, so the result does not depend on the session's setting.
    """
    c = F.col(col) if isinstance(col, str) else col
    instant = F.to_timestamp(c)
    return F.convert_timezone(F.current_timezone(), F.lit(zone), instant.cast("timestamp_ntz"))


def infer_types(raw: DataFrame) -> DataFrame:
    """Content type per text column (S3) in one aggregate pass.

    INTEGER if every non-empty value is an integer, REAL if int-or-real, DATE,
    DATETIME (ISO with offset), TEXT otherwise or when the column is empty.
    A timestamp without offset makes the job fail: the instant is unknown.
    """
    aggs = []
    for c in raw.columns:
        v = F.nullif(F.col(c).cast("string"), F.lit(""))
        aggs += [
            F.count(v).alias(f"{c}__n"),
            F.count_if(v.rlike(RE_INT)).alias(f"{c}__i"),
            F.count_if(v.rlike(RE_INT) | v.rlike(RE_REAL)).alias(f"{c}__r"),
            F.count_if(v.rlike(RE_DATE)).alias(f"{c}__d"),
            F.count_if(v.rlike(RE_TIMESTAMP)).alias(f"{c}__t"),
            F.count_if(v.rlike(RE_TIMESTAMP_NO_ZONE)).alias(f"{c}__z"),
        ]
    one = raw.agg(*aggs)
    parts = ", ".join(
        f"{i}, '{c}', `{c}__n`, `{c}__i`, `{c}__r`, `{c}__d`, `{c}__t`, `{c}__z`"
        for i, c in enumerate(raw.columns))
    s = one.selectExpr(f"stack({len(raw.columns)}, {parts}) AS (position, column_name, n, i, r, d, t, z)")
    kind = (F.when(F.col("n") == 0, "TEXT")
             .when(F.col("i") == F.col("n"), "INTEGER")
             .when(F.col("r") == F.col("n"), "REAL")
             .when(F.col("d") == F.col("n"), "DATE")
             .when(F.col("t") == F.col("n"), "DATETIME")
             .when(F.col("z") > 0, F.raise_error(F.concat(
                 F.lit("column "), F.col("column_name"), F.lit(": timestamp without offset"))).cast("string"))
             .otherwise("TEXT"))
    return s.select("position", "column_name", F.col("n").alias("non_empty"), kind.alias("inferred_type"))


# The logical types of the strict loader and the Spark type each maps to.
STRICT_TYPES = {"T": "string", "I": "bigint", "R": "double", "D": "timestamp"}


def strict_cast_audit(raw: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Per column and logical type: non-null inputs, converted, failed.

    ``spec`` maps column -> one of T/I/R/D.  ``try_cast`` turns a failure into
    NULL, so a failure is "raw not null and cast null"; :func:`strict_cast`
    turns any failure into a job error.
    """
    aggs = []
    for c, t in spec.items():
        v = F.col(c).cast("string")
        cast = v.try_cast(STRICT_TYPES[t])
        aggs += [F.count(v).alias(f"{c}__n"),
                 F.count_if(v.isNotNull() & cast.isNull()).alias(f"{c}__f")]
    one = raw.agg(*aggs)
    parts = ", ".join(f"'{c}', '{t}', `{c}__n`, `{c}__f`" for c, t in spec.items())
    s = one.selectExpr(f"stack({len(spec)}, {parts}) AS (column_name, rule, non_null, failed)")
    return s.select("column_name", "rule", "non_null",
                    (F.col("non_null") - F.col("failed")).alias("converted"), "failed")


def strict_cast(raw: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Cast per ``spec``; a value that does not convert fails the task with its column name."""
    out = []
    for c in raw.columns:
        if c not in spec:
            out.append(F.col(c))
            continue
        v = F.col(c).cast("string")
        cast = v.try_cast(STRICT_TYPES[spec[c]])
        out.append(F.when(v.isNull() | cast.isNotNull(), cast)
                   .otherwise(F.raise_error(F.concat(F.lit(f"column {c}: cannot convert "), v)))
                   .cast(STRICT_TYPES[spec[c]]).alias(c))
    return raw.select(*out)


#: Bytes of a file that a hashing task holds at a time.
PIECE = 8 << 20


def file_hashes(spark: SparkSession, path_glob: str, piece: int = PIECE) -> DataFrame:
    """SHA-256 of each input file (S11): executors stream the files in pieces, so a file of any size takes constant memory.

    Spark lists the files (no content is loaded, and empty files are left out, as by all its readers); tasks open them by their URI with Arrow's file systems (local, HDFS, object stores).
    """
    files = spark.read.format("binaryFile").load(path_glob).select("path", "length")

    def digest(batches):
        import hashlib
        import re
        from urllib.parse import unquote

        import pandas as pd
        from pyarrow import fs
        for batch in batches:
            sums = []
            for path in batch["path"]:
                local = re.match(r"file:/+(.*)", path)
                system, name = (fs.LocalFileSystem(), "/" + unquote(local.group(1))) if local else fs.FileSystem.from_uri(path)
                sha = hashlib.sha256()
                with system.open_input_stream(name, buffer_size=0) as stream:
                    while data := stream.read(piece):
                        sha.update(data)
                sums.append(sha.hexdigest())
            yield pd.DataFrame({"path": batch["path"], "length": batch["length"], "sha256": sums})

    return files.repartition("path").mapInPandas(digest, "path string, length bigint, sha256 string")


def manifest_check(hashes: DataFrame, manifest: DataFrame) -> DataFrame:
    """Join file hashes to a manifest (path, sha256): missing, extra and changed files."""
    m = manifest.select("path", F.col("sha256").alias("expected"))
    return (hashes.join(m, "path", "full")
            .select("path", "sha256", "expected",
                    F.col("sha256").eqNullSafe(F.col("expected")).alias("ok")))


def unchanged(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files whose hash differs between two readings of the same inputs (S11); empty when nothing changed."""
    return manifest_check(after, before).filter(~F.col("ok"))


def read_ragged_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """CSV whose rows may be short or long (S10): short rows are padded with NULL, and ``__overflow`` holds the
    first cell beyond the schema, so that overflowing rows can be counted and rejected by the caller."""
    wide = T.StructType([*schema.fields, T.StructField("__overflow", T.StringType())])
    return (spark.read.schema(wide).option("header", True).option("enforceSchema", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').option("sep", sep).option("nullValue", "").option("emptyValue", None)
            .option("mode", "PERMISSIVE").option("encoding", "UTF-8").csv(path))


def overflow_audit(ragged: DataFrame) -> DataFrame:
    """Rows and overflowing rows of ``read_ragged_csv``."""
    return ragged.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("__overflow").isNotNull()).alias("overflowing"))


def file_order(df: DataFrame) -> DataFrame:
    """``df`` with __path and __block (where a record was read) and __id, which grows with the place in a block.

    A block is read by one task from its start, and consecutive records get consecutive ids.
    """
    return df.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__block"),
                     F.monotonically_increasing_id().alias("__id"))


def number_records(df: DataFrame, out: str = "record_no") -> DataFrame:
    """1-based record numbers in file order for a table without a key (S5): files by path, records by their place in the file.

    ``df`` must come straight from files.  Spark packs files into tasks by size, so places are
    written out with the rows once (a retried task cannot number anew); blocks in order get offsets from their small
    table of counts, and a record's number is its block's offset and its place in the block.  Nothing is sorted but the blocks.
    """
    from pyspark.sql import Window

    from flowcube.operators.materialize import materialize

    placed = materialize(file_order(df))
    blocks = placed.groupBy("__path", "__block").agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    before = Window.orderBy("__path", "__block").rowsBetween(Window.unboundedPreceding, -1)  # one row per block of a file
    blocks = blocks.withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    numbered = placed.join(blocks, ["__path", "__block"])
    return numbered.withColumn(out, (F.col("__offset") + F.col("__id") - F.col("__first") + 1).cast("bigint")).drop(
        "__path", "__block", "__id", "__n", "__first", "__offset")


def placed_records(df: DataFrame, out: str) -> DataFrame:
    """``df``, read straight from Parquet, with a record number in ``out``: files by path, then the row's index in its file; not gapless."""
    from pyspark.sql import Window
    files = df.select(F.col("_metadata.file_path").alias("__path")).distinct()
    files = files.withColumn("__file", F.row_number().over(Window.orderBy("__path")))  # one row per file
    rows = df.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__row"))
    return rows.join(F.broadcast(files), "__path").withColumn(out, F.shiftleft(F.col("__file").cast("bigint"), 40) + F.col("__row")).drop("__path", "__file", "__row")


def copy_table(df: DataFrame, path: str, timestamps: list[str]) -> DataFrame:
    """Copy a table to Parquet with the named text columns cast to timestamps (S12); a bad text fails the copy."""
    cols = [F.col(c).cast("timestamp_ntz").alias(c) if c in timestamps else F.col(c) for c in df.columns]
    write_table(df.select(*cols), path)
    return df.sparkSession.read.parquet(path)


def load_parity(source: DataFrame, loaded: DataFrame, name: str) -> DataFrame:
    """Gate row: loaded rows against source rows."""
    n = source.agg(F.count(F.lit(1)))
    return loaded.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(f"rows:{name}").alias("gate"), F.col("n").cast("string").alias("observed"), n.scalar().cast("string").alias("expected"),
        (F.col("n") == n.scalar()).alias("ok"))


def write_semicolon_csv(df: DataFrame, path: str) -> None:
    """Semicolon CSV with header and a byte-order mark (S13): the mark leads the first header name of each file."""
    first = df.columns[0]
    df.withColumnRenamed(first, "\ufeff" + first).write.mode("overwrite").option("sep", ";").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines report sink."""
    df.write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet sink, optionally partitioned."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def first_records(df: DataFrame, n: int = 10) -> DataFrame:
    """The first n parsed records (S16) — records, not physical lines."""
    return df.limit(n)


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per table (S17, Q1): rows read, rows that the files hold by their last row's index, and whether they agree."""
    parts = []
    for name, df in frames.items():
        files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")).groupBy("f").agg(
            F.count(F.lit(1)).alias("n"), (F.max("i") + 1).alias("m"))
        parts.append(files.agg(F.lit(name).alias("table_name"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                               F.coalesce(F.sum("m"), F.lit(0)).alias("expected")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("ok", F.col("rows") == F.col("expected"))

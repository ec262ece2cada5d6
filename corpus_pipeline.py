"""A training-data pipeline: each stage is one of the operators, applied to all its predecessor kept.

``run`` writes every stage as Parquet in the shared checkpoint folder and hands the reread table to the next.
All stages but the last return the columns of documents:

* quality     drops documents that fail the rules and removes lines that many documents of a host share (a count,
              whatever the size of the host) from the others;
* one_of_each keeps the document of smallest doc_id of each near-duplicate component (5-word shingles, Jaccard 0.8);
* secrets     masks every found secret in the text (n_chars follows), and keeps all documents;
* mix         orders all documents by the Pfair interleaving of their sources;
* tokens      returns doc_id, lang, source, n_tokens, ids of the byte-level BPE, whether decoding gives the text back,
              and the document's place in the table that it read: rows in the order of ``place`` are the mixed corpus.

Readers of Parquet do not keep the order of rows, but every row knows its file and its index there, and mix writes
its order into files that follow one another.  The last stage turns these into ``place``, 1 to the number of rows.

Nulls, empty and very long texts, repeated rows, empty tables and further columns are handled as the operators
state; further columns pass through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowcube.llm import bpe, jaccard_join, line_quality, mixing, secrets
from flowcube.llm.common import documents
from flowcube.operators.materialize import materialize

#: Near duplicates of stage one_of_each: words of a shingle, and least Jaccard similarity in per cent (op7 has its own).
NEAR_WORDS, NEAR_LINK = 5, 80
#: Files of the mixed table (some 100 bytes a name) whose offsets are broadcast.
FILES_MAX = 50_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_quality.clean(docs, max_share=None)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs, words=NEAR_WORDS, link=NEAR_LINK)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def text_digest() -> Column:
    return F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)


def within_source(digest: Column) -> Column:
    """Order within a source: by doc_id and text, so that rows without a doc_id, or with the same, have a fixed place too."""
    return F.md5(F.concat_ws("\x1f", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), digest).cast("binary"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.interleave(docs, order=within_source(text_digest()))


def placed(docs: DataFrame) -> DataFrame:
    """``docs``, read straight from Parquet, with ``place``: the row's number in the order of the files that a sorted write leaves."""
    rows = docs.select(*docs.columns, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    files = docs.select(F.col("_metadata.file_path").alias("__file")).groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    # part files are numbered; longer names hold the larger numbers.  One row per file
    before = Window.orderBy(F.length("__file"), "__file").rowsBetween(Window.unboundedPreceding, -1)
    files = materialize(files.select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")))
    # texts stay where they are read while the files are few enough to broadcast; beyond that they are shuffled by file
    few = files.count() <= FILES_MAX
    return rows.join(F.broadcast(files) if few else files, "__file").withColumn("place", F.col("__offset") + F.col("__row") + 1).drop("__file", "__row", "__offset")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(bpe.VOCABULARY)
    keep = placed(docs).select("doc_id", "lang", "source", "text", "place", text_digest().alias("digest"))
    # written before it is decoded, so that no text is encoded twice
    out = materialize(bpe.encode(keep, path, ["doc_id", "lang", "source", "place", "digest"]))
    back = F.sha2(bpe.decode(F.col("ids"), path), 256)
    return out.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                      (back == F.col("digest")).alias("round_trip"), "place")


STAGES = [("quality", quality), ("one_of_each", one_of_each), ("secrets", mask_secrets), ("mix", mix), ("tokens", tokens)]

#: The BPE fold and the randomness battery are not expressed in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}

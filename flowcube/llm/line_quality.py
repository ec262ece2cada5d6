"""Quality rules with cross-document line frequency.

Base rules look at one document.  The method looks across documents: lines are
normalised (words joined by one blank, A-Z lower-cased) and hashed; for every
host (the document's source) and line the distinct documents holding it are
counted, where documents with equal texts are one.  A line is above the limits if it stands in at
least MIN_DOCS distinct documents of a host; op4, as its SQL says, asks besides that they are more than
MAX_SHARE of the host's.  The pipeline goes by the count alone, so a line that so many documents share
is judged alike in a host of any size.  Lines above the limits are
removed everywhere but in the host's first document (smallest doc_id) that holds them, so text
that many near copies share survives once.  A document that keeps less than MIN_LEFT of its words is rejected as depleted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcube.llm.common import documents
from flowcube.operators.materialize import materialize

#: Base rule: fewer words fail.
MIN_WORDS = 50
#: Base rule: more than this percentage of words in repeated 3-word windows fails.
MAX_REPEAT = 50
#: A line in fewer distinct documents of a host is never removed.
MIN_DOCS = 20
#: Percentage of a host's distinct documents above which op4 removes a line.
MAX_SHARE = 10
#: Percentage of words a document must keep.
MIN_LEFT = 30

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = "#*$%&|<>"


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which occurs at least twice."""
    import numpy as np
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1].astype(np.int64)
    _, where, count = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    twice = count[where] > 1
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= twice
    return int(covered.sum())


def measure(text: str) -> tuple[list[int], list[bytes | None], list[int]]:
    """Base measures, and per line its key (None without words) and number of words."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly the six ASCII blanks
    chars = len(text) - sum(text.count(c) for c in " \t\n\v\f\r")
    keys, sizes, seen, dups = [], [], set(), 0
    for line in raw.split(b"\n"):
        parts = line.split()
        sizes.append(len(parts))
        if not parts:
            keys.append(None)
            continue
        dups += line in seen
        seen.add(line)
        keys.append(hashlib.blake2b(b" ".join(parts).lower(), digest_size=16).digest())
    return [len(words), chars, sum(text.count(c) for c in SYMBOLS), dups, repeat_words(words)], keys, sizes


def measured(docs: DataFrame, keep: list[str], host: str) -> DataFrame:
    """``keep`` columns, base measures, ``q_id``, ``q_host``, ``q_text`` (hash) and ``q_lines`` per document."""
    line = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("words", T.IntegerType())])
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in BASE]
                          + [T.StructField("q_doc", T.LongType()), T.StructField("q_host", T.StringType()),
                             T.StructField("q_text", T.BinaryType()), T.StructField("q_lines", T.ArrayType(line))])
    lines_type = pa.list_(pa.struct([("key", pa.binary()), ("words", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, lines = [], []
            for value in batch.column("q_body"):
                text = value.as_py() or ""
                numbers, keys, sizes = measure(text)
                base.append(numbers)
                lines.append([{"key": k, "words": n} for k, n in zip(keys, sizes)])
            cols = [batch.column(c) for c in keep]
            cols += [pa.array([b[i] for b in base], pa.int64()) for i in range(len(BASE))]
            cols += [batch.column("q_doc"), batch.column("q_host"), batch.column("q_text"), pa.array(lines, lines_type)]
            yield pa.RecordBatch.from_arrays(cols, schema.names)

    source = docs.select(*keep, *identity(host), F.col("text").alias("q_body"))
    return source.mapInArrow(run, schema).withColumn("q_id", F.monotonically_increasing_id())


def identity(host: str) -> list:
    """Columns that a verdict depends on: doc_id, host and a hash of the text."""
    return [F.col("doc_id").cast("bigint").alias("q_doc"),
            F.coalesce(F.concat(F.lit("h:"), F.col(host).cast("string")), F.lit("null")).alias("q_host"),
            F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).alias("q_text")]


def judge(docs: DataFrame, keep: list[str], host: str = "source", min_docs: int = MIN_DOCS, max_share: int | None = MAX_SHARE,
          min_left: int = MIN_LEFT, with_identity: bool = False) -> DataFrame:
    """``keep`` columns of every document, its base measures, ``base_failed``, ``kept`` and ``removed`` line numbers.

    Null and empty texts have no words and fail the base rules; a null host is a host of its own; rows
    that repeat a doc_id are judged one by one (all are first if the doc_id is first); an empty table gives
    an empty result.  Without ``max_share`` the count ``min_docs`` decides alone.  ``keep`` must not hold the names of added columns.  ``with_identity`` adds what a
    verdict depends on (q_doc, q_host, q_text).
    """
    table = materialize(measured(docs, keep, host))
    lines = table.select("q_id", "q_doc", "q_host", "q_text", F.posexplode("q_lines").alias("pos", "line"))
    lines = lines.select("q_id", "q_doc", "q_host", "q_text", "pos", "line.key", "line.words").filter("key is not null")
    per_text = lines.groupBy("q_host", "key", "q_text").agg(F.min("q_doc").alias("first"))
    counts = per_text.groupBy("q_host", "key").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("first"))
    # lines above the limits: a host has at most (its lines / limit) of them
    above = counts.filter(F.col("n") >= min_docs)
    if max_share is not None:
        hosts = table.select("q_host", "q_text").distinct().groupBy("q_host").agg(F.count(F.lit(1)).alias("texts"))
        above = above.join(hosts, "q_host").filter(F.col("n") * 100 > F.col("texts") * max_share)
    above = above.select("q_host", "key", "first")
    gone = lines.join(above, ["q_host", "key"]).filter("not (q_doc <=> first)").groupBy("q_id").agg(
        F.sum("words").alias("lost"), F.collect_list("pos").alias("removed"))
    out = table.join(gone, "q_id", "left").withColumn("lost", F.coalesce("lost", F.lit(0)))
    out = out.withColumn("base_failed", F.expr(
        f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT} * n_words"))
    out = out.withColumn("kept", ~F.col("base_failed") & ((F.col("n_words") - F.col("lost")) * 100 >= F.col("n_words") * min_left))
    extra = ["q_doc", "q_host", "q_text"] if with_identity else []
    return out.select(*keep, *extra, *BASE, "base_failed", "kept", F.coalesce("removed", F.expr("cast(array() as array<int>)")).alias("removed"))


def clean(docs: DataFrame, host: str = "source", max_share: int | None = MAX_SHARE) -> DataFrame:
    """Kept documents without their removed lines; columns as in ``docs``, n_chars following the text where present.

    Verdicts are found on a table without texts and meet the documents by what they depend on, so repeated
    rows share one verdict and every row that is kept stays.
    """
    fields = docs.columns
    verdicts = judge(docs.select("doc_id", "text", host), [], host, max_share=max_share, with_identity=True).filter("kept")
    verdicts = verdicts.dropDuplicates(["q_doc", "q_host", "q_text"]).select(
        F.coalesce("q_doc", F.lit(0)).alias("v_doc"), F.col("q_doc").isNull().alias("v_null"), F.col("q_host").alias("v_host"),
        F.col("q_text").alias("v_text"), "removed")
    rows = docs.select(F.struct(*fields).alias("__doc"), *identity(host))
    out = rows.join(verdicts, (F.coalesce("q_doc", F.lit(0)) == F.col("v_doc")) & (F.col("q_doc").isNull() == F.col("v_null"))
                    & (F.col("q_host") == F.col("v_host")) & (F.col("q_text") == F.col("v_text")))
    lines = F.split(F.col("__doc.text"), "\n")
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed")), lambda i: F.get(lines, i))
    changed = F.size("removed") > 0
    out = out.withColumn("__text", F.when(changed, F.array_join(left, "\n")).otherwise(F.col("__doc.text")))
    cols = []
    for c in fields:
        old = F.col("__doc").getField(c)
        if c == "text":
            old = F.col("__text")
        elif c == "n_chars":
            old = F.when(changed, F.length("__text").cast(docs.schema[c].dataType)).otherwise(old)
        cols.append(old.alias(c))
    return out.select(*cols)


def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and verdicts of every document."""
    out = judge(documents(spark, sf_dir).select("doc_id", "text", "source"), ["doc_id"])
    return out.select("doc_id", *BASE, "base_failed", "kept")


_LINES = r"""
WITH d AS (SELECT doc_id, 'h' || coalesce(':' || source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, host, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             string_split(t, chr(10)) AS ls FROM d),
grams AS (SELECT doc_id, i, (ws[i], ws[i + 1], ws[i + 2]) AS g
          FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
l AS (SELECT doc_id, host, md5(t) AS tk, raw,
             regexp_extract_all(raw, '[^\x20\x09-\x0D]+') AS lw
      FROM (SELECT doc_id, host, t, unnest(ls) AS raw FROM w)),
n AS (SELECT doc_id, host, tk, raw, len(lw) AS words,
             translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM l WHERE len(lw) > 0),
dup AS (SELECT doc_id, sum(c - 1) AS n_dup_lines FROM (SELECT doc_id, raw, count(*) AS c FROM n GROUP BY ALL) GROUP BY doc_id),
cnt AS (SELECT host, key, count(DISTINCT tk) AS docs, min(doc_id) AS first FROM n GROUP BY ALL),
hosts AS (SELECT host, count(DISTINCT md5(t)) AS texts FROM d GROUP BY host),
above AS (SELECT host, key, first FROM cnt JOIN hosts USING (host)
          WHERE docs >= {min_docs} AND docs * 100 > texts * {max_share}),
lost AS (SELECT n.doc_id, sum(n.words) AS lost FROM n JOIN above USING (host, key)
         WHERE n.doc_id <> above.first GROUP BY n.doc_id)
"""
ORACLE_OP4 = _LINES.format(min_docs=MIN_DOCS, max_share=MAX_SHARE) + rf"""
, m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
       CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
       CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
       CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
       CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
       CAST(coalesce(lost, 0) AS BIGINT) AS lost
FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (n_words - lost) * 100 >= n_words * {MIN_LEFT} AS kept
FROM (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed FROM m)
"""

QUERIES = {"op4_line_frequency": op4_line_frequency}
ORACLE = {"op4_line_frequency": ORACLE_OP4}

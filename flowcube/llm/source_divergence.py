"""Audit of how far sources of a language differ in their terms, by cells of equal counts.

A term of a group (language, source) matters only through two numbers: its count in the group and its count
in what it is compared with (the language, or another source).  Terms are therefore grouped into cells of equal count
pairs with a multiplicity; the divergence f is evaluated once per cell.

* Ranking terms: cells of one group with equal f are merged, the merged cells are ranked by f with cumulative
  multiplicity, and only those that begin before rank TOP are expanded to terms, in UTF-8 order.
* Ranking sources: terms are grouped into cells of equal counts in all sources of the language.  For pairs of sources in which both
  counts are positive f is evaluated once per such cell and added up in the task.  Cells with a zero are never enumerated per pair of sources: with M(a) terms
  of count a in a source, D of them positive and m(a, b) terms in a cell,

      sum f = sum M_s(a) (f(a,0) - f(0,0)) + sum M_t(b) (f(0,b) - f(0,0)) + V f(0,0)
              + sum m(a,b) (f(a,b) - f(a,0) - f(0,b) + f(0,0)).

Tasks count terms by group before anything is shuffled.  The rows of a hot group are salted by term wherever they meet
numbers of their group.  Sums are DECIMAL(38,0), quotients integral: all arithmetic is exact.

Defined cases: null text, lang and source count as empty; a group without terms takes part with counts of zero; a
language without kept terms gives value 0 for each pair of its sources; repeated rows count each time; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowcube.llm.common import documents
from flowcube.operators.materialize import materialize

#: A language keeps the terms of at least so many of its documents.
MIN_DOCS = 3
#: Fixed-point one of the smoothed shares.
UNIT = 1_000_000_000
#: Ranks of the term report.
TOP = 200
#: Pieces of a hot group where its rows meet numbers of the group.
SALTS = 16
#: Bytes of text that a task counts at once (a longer document is counted alone).
PIECE_BYTES = 8 << 20

#: Bytes outside terms become blanks; A-Z lower-cased.  All bytes from 0x80 on belong to code points that are in terms.
_TERM_BYTES = np.array([b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256)], dtype=np.uint8)

COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def terms(texts: pa.BinaryArray) -> tuple[pa.BinaryArray, np.ndarray]:
    """Terms of all texts, one after the other, and the row of each: matches of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` in UTF-8, A-Z lower-cased."""
    at = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    data = _TERM_BYTES[raw]
    inside = data != 32
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = at[:-1][at[:-1] < at[1:]]
    begins[firsts] = inside[firsts]  # a term ends with its text
    starts = np.flatnonzero(begins)
    offsets = np.append(np.cumsum(inside)[starts] - 1, np.count_nonzero(inside)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    return words, np.searchsorted(at, starts, side="right") - 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents by (lang, source, term) of a piece of a task's rows."""
    for batch in batches:
        groups = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
        texts = batch.column("text").cast(pa.binary())
        size = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        begin = 0
        while begin < batch.num_rows:
            end = int(max(begin + 1, np.searchsorted(size, size[begin] + PIECE_BYTES, side="right") - 1))
            words, row = terms(texts.slice(begin, end - begin))
            code = words.dictionary_encode()
            many = max(1, len(code.dictionary))
            number: dict[tuple[str, str], int] = {}
            of_row = np.array([number.setdefault(g, len(number)) for g in groups[begin:end]], dtype=np.int64)
            # once per document and term, then per group and term
            each, times = np.unique(row * many + code.indices.to_numpy().astype(np.int64), return_counts=True)
            key = of_row[each // many] * many + each % many
            order = np.argsort(key, kind="stable")
            key, times = key[order], times[order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
            n = np.add.reduceat(times, first) if len(first) else first
            docs = np.diff(np.append(first, len(key)))
            names = [pa.array([g[i] for g in number], pa.string()).take(pa.array(key[first] // many)) for i in (0, 1)]
            term = code.dictionary.take(pa.array(key[first] % many)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*names, term, pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
                                             names=["lang", "source", "term", "n", "docs"])
            begin = end


def plain(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def term_counts(docs: DataFrame) -> DataFrame:
    """Occurrences ``n`` and documents ``docs`` by lang, source and term."""
    return plain(docs).mapInArrow(_count, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / (total + kept)), as a long."""
    whole = F.greatest(total + kept, F.lit(1)).cast("decimal(38,0)")
    return 1 + F.call_function("div", (count + 1).cast("decimal(38,0)") * F.lit(UNIT), whole)


def f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


class Audit:
    """The tables that both reports read: kept terms with their vectors of counts, groups, languages."""

    def __init__(self, docs: DataFrame):
        group = plain(docs).select("lang", "source").distinct()
        vector = F.sort_array(F.collect_list(F.struct("source", "n"))).alias("vector")  # one entry per source of the language
        self.kept = materialize(term_counts(docs).groupBy("lang", "term")
                                .agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), vector)
                                .filter(F.col("docs") >= MIN_DOCS).drop("docs"))
        sums = self.rows().groupBy("lang", "source").agg(F.sum("n").alias("size"))
        self.langs = (group.select("lang").distinct().join(
            self.kept.groupBy("lang").agg(F.sum("total").alias("lang_size"), F.count(F.lit(1)).alias("kept")), "lang", "left")
            .select("lang", F.coalesce("lang_size", F.lit(0)).alias("lang_size"), F.coalesce("kept", F.lit(0)).alias("kept")))
        self.groups = materialize(group.join(sums, ["lang", "source"], "left").join(self.langs, "lang")
                                  .select("lang", "source", F.coalesce("size", F.lit(0)).alias("size"), "lang_size", "kept"))

    def rows(self) -> DataFrame:
        """One row per kept term and source that has it: lang, term, total, source, n."""
        return self.kept.select("lang", "term", "total", F.explode("vector").alias("v")).select("lang", "term", "total", "v.source", "v.n")

    def top_terms(self, top: int = TOP) -> DataFrame:
        """Terms more frequent in a group than in its language: lang, source, item, value, rank up to ``top``."""
        group = ["lang", "source"]
        cells = self.rows().groupBy(*group, "n", "total").agg(F.count(F.lit(1)).alias("m")).join(self.groups, group)
        cells = (cells.withColumn("p", share(F.col("n"), F.col("size"), F.col("kept")))
                 .withColumn("q", share(F.col("total"), F.col("lang_size"), F.col("kept"))).filter("p > q")
                 .select(*group, "n", "total", "m", f(F.col("p"), F.col("q")).alias("value")))
        cells = materialize(cells)
        merged = cells.groupBy(*group, "value").agg(F.sum("m").alias("m"))
        order = Window.partitionBy(*group).orderBy(F.desc("value"))
        merged = merged.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)
        earlier = F.coalesce(F.sum("m").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        merged = merged.withColumn("before", earlier).filter(F.col("before") < top).select(*group, "value", "before")
        wanted = cells.join(merged, [*group, "value"]).select(*group, "n", "total", "value", "before")
        wanted = wanted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = self.rows().withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int"))
        rows = rows.join(wanted, [*group, "n", "total", "salt"]).select(*group, F.col("term").alias("item"), "value", "before")
        within = F.row_number().over(Window.partitionBy(*group, "value").orderBy("item"))
        rows = rows.withColumn("at", within).filter(F.col("at") <= top)
        return (rows.withColumn("rank", (F.col("at") + F.col("before")).cast("int")).filter(F.col("rank") <= top)
                .select(*group, "item", "value", "rank"))

    def source_pairs(self) -> DataFrame:
        """Every other source of a group's language by divergence: lang, source, item, value, rank."""
        zero = F.lit(0).cast("bigint")
        big = lambda c: c.cast("decimal(38,0)")
        total = lambda c, m: F.sum(big(m) * c.cast("decimal(20,0)")).cast("decimal(38,0)")
        size = self.groups.select("lang", "source", "kept", share(zero, F.col("size"), F.col("kept")).alias("p0"))
        one = lambda name, p0: size.select("lang", F.col("source").alias(name), F.col("p0").alias(p0))
        pairs = materialize(one("s", "p0").join(one("t", "q0"), "lang").filter("s <> t"))

        # terms of equal vectors are one cell; counts become shares once, by the sizes of the language's sources
        sizes = self.groups.groupBy("lang", "kept").agg(F.map_from_entries(F.collect_list(F.struct("source", "size"))).alias("sizes"))
        vectors = self.kept.groupBy("lang", "vector").agg(F.count(F.lit(1)).alias("m")).join(sizes, "lang")
        shares = F.transform("vector", lambda x: F.struct(
            x["source"].alias("s"), share(x["n"], F.col("sizes")[x["source"]], F.col("kept")).alias("p"),
            share(zero, F.col("sizes")[x["source"]], F.col("kept")).alias("p0")))
        cells = materialize(vectors.select("lang", "m", shares.alias("cell")))

        # both counts positive: each unordered pair of a cell's sources, evaluated both ways and summed in the task
        first = cells.select("lang", "m", "cell", F.posexplode("cell").alias("i", "x"))
        both = first.select("lang", "m", "x", F.explode(F.expr("slice(cell, i + 2, size(cell))")).alias("y"))
        p, p0, q, q0 = (F.col(c) for c in ("x.p", "x.p0", "y.p", "y.p0"))
        more = lambda p, p0, q, q0: f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)
        both = both.groupBy("lang", F.col("x.s").alias("a"), F.col("y.s").alias("b")).agg(
            total(more(p, p0, q, q0), F.col("m")).alias("ab"), total(more(q, q0, p, p0), F.col("m")).alias("ba"))
        both = both.select("lang", F.explode(F.array(F.struct(F.col("a").alias("s"), F.col("b").alias("t"), F.col("ab").alias("v")),
                                                     F.struct(F.col("b").alias("s"), F.col("a").alias("t"), F.col("ba").alias("v")))).alias("r")).select("lang", "r.*")
        # cells of one source beside a zero of the other, in both orders
        ones = cells.select("lang", "m", F.explode("cell").alias("x")).groupBy("lang", F.col("x.s").alias("s"), F.col("x.p").alias("p")).agg(F.sum("m").alias("m"))
        beside = pairs.join(ones, ["lang", "s"])  # p0 is the share of a zero in s, q0 in t
        p, p0, q0 = (F.col(c) for c in ("p", "p0", "q0"))
        beside = beside.groupBy("lang", "s", "t").agg(total(f(p, q0) - f(p0, q0), F.col("m")).alias("st"),
                                                      total(f(q0, p) - f(q0, p0), F.col("m")).alias("ts"))
        beside = beside.select("lang", F.explode(F.array(F.struct("s", "t", F.col("st").alias("v")),
                                                         F.struct(F.col("t").alias("s"), F.col("s").alias("t"), F.col("ts").alias("v")))).alias("r")).select("lang", "r.*")
        sums = both.unionByName(beside).groupBy("lang", "s", "t").agg(F.sum("v").cast("decimal(38,0)").alias("more"))
        kept = self.groups.select("lang", "kept").distinct()
        out = pairs.join(kept, "lang").join(sums, ["lang", "s", "t"], "left")
        value = F.coalesce("more", big(F.lit(0))) + (big(F.col("kept")) * f(F.col("p0"), F.col("q0")).cast("decimal(20,0)")).cast("decimal(38,0)")
        out = out.select("lang", F.col("s").alias("source"), F.col("t").alias("item"), value.cast("bigint").alias("value"))
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return out.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame) -> DataFrame:
    """Both reports in one table: lang, source, part (``pair`` or ``term``), item, value, rank."""
    tables = Audit(docs)
    parts = [tables.source_pairs().withColumn("part", F.lit("pair")), tables.top_terms().withColumn("part", F.lit("term"))]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir))


QUERIES = {"op11_source_divergence": op11}

ORACLE = {"op11_source_divergence": r"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as t from documents),
w as (
  select r, lang, source, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term
  from (select r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as x from d)),
k as (select lang, term, count(*) as total from w group by lang, term having count(distinct r) >= 3),
g as (select distinct lang, source from d),
c as (select w.lang, w.source, w.term, count(*) as n from w join k using (lang, term) group by all),
v as (select lang, count(*)::hugeint as v, sum(total)::hugeint as size from k group by lang),
z as (select lang, source, sum(n)::hugeint as size from c group by all),
p as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (coalesce(z.size, 0) + v.v) as p,
    1 + (1000000000::hugeint * (k.total + 1)) // (v.size + v.v) as q
  from g join k using (lang) join v using (lang) left join z on z.lang = g.lang and z.source = g.source
  left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
pairs as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::hugeint as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
every as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join pairs x on x.lang = a.lang and x.source = a.source and x.item = b.source
  union all
  select lang, source, 'term', term, ((p - q) * (p - q)) // q from p where n > 0 and p > q)
select lang, source, part, item, value::bigint as value,
  (row_number() over (partition by lang, source, part order by value desc, item))::int as rank
from every qualify part = 'pair' or rank <= 200"""}

"""Periodic runs in the word sequence of a document.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), of at
least max(MIN_WORDS, MIN_TIMES * q) words, that no neighbouring word extends keeping period q.

Method, per document.  A suffix automaton of the words is built; its suffix links form a tree whose nodes
are the substrings by the places where they end.  Then the words are appended one by one: word i makes i the last
occurrence of every substring that ends there, which are the nodes from the state of prefix i up to the root.  A
link-cut tree keeps that tree as vertical path segments of one last occurrence each, and an access to the prefix's state
recolours the segments on its way.  A segment met with last occurrence e, entered at a node of length m, says that
the longest common suffix of the prefixes e and i has m words and that nothing as long ended in between.  If the distance q = i - e
is at most m, the 2q words up to i are a square of a primitive root, so they lie in exactly one run of period q: it
starts m words before the second root's end, and is extended to the right word by word.  The tree of the whole text is used from the start, so
nothing has to be linked or cut on the way; a state of the whole text's automaton stands for substrings that
also share all ends within any prefix.

Screen, exact: every word of a run lies in a window of 16 words that occurs twice in its document (a run of 24
words or 3 periods repeats at least 16 words at distance q).  Hashes of such windows, sorted per chunk of documents, leave the stretches that can hold runs; only they go
through the automaton, and a maximal run always lies in one stretch.  Chance equality of hashes costs time only.

Words are ``[^\\x20\\x09-\\x0D]+`` on UTF-8 bytes.  Null and empty texts, and texts without a word, have no runs and an
empty collapsed text.  Repeated rows are judged each for itself.  All columns of ``docs`` pass through; the result is one struct column, which, as
``withColumn`` does, replaces a column of that name.  A document is processed by one task; its memory is in proportion to its words in stretches.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcube.llm.common import documents

#: A run has at least so many words, and so many periods.
MIN_WORDS, MIN_TIMES = 24, 3
#: Words of the screen's windows: a run repeats at least so many words one period on.
WINDOW = 16
#: Words that are screened together (a longer document is screened alone).
CHUNK_WORDS = 400_000

Run = tuple[int, int, int]  # start, length, period

RESULT = "struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>"
ARROW = pa.struct([
    pa.field("n_words", pa.int64()),
    pa.field("runs", pa.list_(pa.struct([pa.field(f, pa.int64()) for f in ("start", "length", "period")]))),
    pa.field("collapsed", pa.string())])


def automaton(word: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix automaton: length and suffix link of every state (0 is the root), and the state of every prefix."""
    step: list[dict[int, int]] = [{}]
    link, length, prefix = [-1], [0], []
    last = 0
    for c in word:
        new = len(length)
        length.append(length[last] + 1)
        step.append({})
        link.append(0)
        p = last
        while p != -1 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p != -1:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(length)
                length.append(length[p] + 1)
                step.append(step[q].copy())
                link.append(link[q])
                while p != -1 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
        prefix.append(new)
    return length, link, prefix


def squares(word: list[int]) -> Iterator[tuple[int, int, int]]:
    """(end i, period q, common suffix m >= q of the prefixes i - q and i) for primitively rooted squares that end at i."""
    length, parent, prefix = automaton(word)
    size = len(length)
    # splay trees over path segments: left is towards the root of the tree; node 0, the empty string, is left out and means none
    left, right, up = [0] * size, [0] * size, parent
    up[0] = 0
    last = [-1] * size  # last occurrence, valid at the root of a splay tree

    def rotate(x: int) -> None:
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b:
            up[b] = p
        up[p] = x
        up[x] = g
        if g and left[g] == p:
            left[g] = x
        elif g and right[g] == p:
            right[g] = x
        else:
            last[x] = last[p]

    def splay(x: int) -> None:
        p = up[x]
        while p and (left[p] == x or right[p] == x):
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                rotate(p if (left[g] == p) == (left[p] == x) else x)
            rotate(x)
            p = up[x]

    for i, state in enumerate(prefix):
        below, x = 0, state
        while x:
            splay(x)
            e = last[x]
            if e >= 0:
                q = i - e
                if q <= length[x]:
                    yield i, q, length[x]
                if right[x]:
                    last[right[x]] = e
            right[x] = below
            below, x = x, up[x]
        splay(state)
        last[state] = i


def runs_of(word: list[int]) -> list[Run]:
    """All runs of a word sequence, by start and period."""
    n, found, seen = len(word), [], {}
    for i, q, common in squares(word):
        if i <= seen.get(q, -1):
            continue
        end = i + 1
        while end < n and word[end] == word[end - q]:
            end += 1
        seen[q] = end - 1
        start = i - q - common + 1
        if end - start >= max(MIN_WORDS, MIN_TIMES * q):
            found.append((start, end - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(texts: list[list[bytes]]) -> list[list[tuple[int, int]]]:
    """Per document the stretches of words that lie in a window of WINDOW words found twice in it."""
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    total = int(sizes.sum())
    if total < WINDOW:
        return out
    doc = np.repeat(np.arange(len(texts)), sizes)
    # Python's hash differs between processes, but only tells equal words of one document here
    g = np.fromiter(map(hash, chain.from_iterable(texts)), dtype=np.int64, count=total).astype(np.uint64)
    g ^= doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    width = 1
    while width < WINDOW:
        g = (g[:-width] * np.uint64(0xD6E8FEB86659FD93)) ^ (g[:-width] >> np.uint64(29)) ^ (g[width:] * np.uint64(0xA0761D6478BD642F))
        width *= 2
    inside = doc[:len(g)] == doc[WINDOW - 1:]
    ordered = np.sort(g[inside])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return out
    at = np.minimum(np.searchsorted(twice, g), len(twice) - 1)
    starts = np.flatnonzero((twice[at] == g) & inside)
    # a window joins the stretch of the one before if they touch in the same document
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (np.diff(starts) > WINDOW) | (doc[starts[1:]] != doc[starts[:-1]])
    first = np.flatnonzero(new)
    final = np.append(first[1:], len(starts)) - 1
    base = np.cumsum(sizes) - sizes
    for a, b in zip(starts[first], starts[final] + WINDOW):
        if b - a >= MIN_WORDS:
            d = int(doc[a])
            out[d].append((int(a - base[d]), int(b - base[d])))
    return out


def document_runs(words: list[bytes], parts: list[tuple[int, int]]) -> list[Run]:
    found: list[Run] = []
    for a, b in parts:
        number: dict[bytes, int] = {}
        found += [(a + s, n, q) for s, n, q in runs_of([number.setdefault(w, len(number)) for w in words[a:b]])]
    return found


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words outside runs and the first period of each run that no other run drops, joined by one space."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept)])


def with_runs(docs: DataFrame, out: str = "periodic", prepare: tuple[str, Callable] | None = None) -> DataFrame:
    """``docs`` and the struct column ``out``: n_words, runs (by start, then period) and the collapsed text.

    ``prepare`` names a column and a function of its value and the words; it returns the words to judge.
    """
    fields = [f for f in docs.schema.fields if f.name != out]
    names = [f.name for f in fields]
    schema = T.StructType([*fields, T.StructField(out, T._parse_datatype_string(RESULT))])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            extra = batch.column(prepare[0]).to_pylist() if prepare else None
            results, chunk, held = [], [], 0
            for i, text in enumerate(texts):
                words = (text.as_py() or b"").split()  # splits at exactly \x20 and \x09-\x0D
                if prepare:
                    words = prepare[1](extra[i], words)
                chunk.append(words)
                held += len(words)
                if held >= CHUNK_WORDS or i + 1 == len(texts):
                    for ws, parts in zip(chunk, stretches(chunk)):
                        runs = document_runs(ws, parts)
                        results.append({"n_words": len(ws), "collapsed": collapsed(ws, runs).decode(),
                                        "runs": [dict(zip(("start", "length", "period"), r)) for r in runs]})
                    chunk, held = [], 0
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(results, ARROW)], names=[*names, out])

    return docs.mapInArrow(judge, schema)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """op12's text: one document in ten becomes periodic from some word on (a document without an id never does)."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    df = with_runs(docs, prepare=("doc_id", planted)).select("doc_id", "periodic.runs", "periodic.collapsed")
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(
        r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    df = df.withColumn("best", best)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.when(F.size("runs") == 0, F.lit("")).otherwise(F.concat(F.concat_ws("\n", lines), F.lit("\n")))
    return df.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES = {"op12_periodic_runs": op12}

#: Maximal repetitions over all periods are quadratic in SQL; the tests compare with the definition.
ORACLE: dict[str, str] = {}

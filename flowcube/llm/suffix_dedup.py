"""Removal of repeated 50-byte strings by a common-prefix-aware distributed merge sort of suffixes.

A byte goes if a 50-byte string over it also starts in a document of smaller
doc_id.  Every 50-byte window has one anchor: the leftmost least hash
among its 20-byte grams.  Equal windows have equal anchors at equal offsets, so only suffixes that
start at anchors are sorted (about one position in sixteen), each with the bytes left of the anchor
that its windows reach.

1. Anchor hashes are exchanged; those seen in one document only cannot start a match and stop here.
2. Every bucket of documents sorts its remaining anchor suffixes into runs, one per
   merge partition, and front-codes them: the length of the prefix shared with the suffix before, then the rest.
3. Each partition merges its runs with a loser tree whose entries carry their common prefix with the
   last suffix output.  Entries with different known prefixes are ordered by these alone; equal ones are
   compared from that position on.  No known prefix is compared again.
4. Suffixes with a common gram stand together in merged order.  There each window (offset i from the
   anchor) is compared by its i bytes to the left and 50 - i to the right, and
   ranges of windows that a smaller doc_id also has are sent back to their document.

Whole copies of a text are known from one hash per document; they leave before step 2.
Groups are bounded: documents lie in buckets of about BUCKET_BYTES by a hash, hot suffixes are reduced to
distinct ones in every run, and variants of a gram are grouped in linear time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowcube.llm.common import documents
from flowcube.operators.materialize import materialize

#: Length of a repeated string, and of the grams that anchors are chosen from.
LENGTH, GRAM = 50, 20
#: Grams in a window.
SPAN = LENGTH - GRAM + 1
#: Text bytes per bucket of documents, and per merge partition.
BUCKET_BYTES = 8_000_000
#: Windows hashed at once (bounds memory for a text of any length, and stays in the processor's cache).
PIECE = 1 << 16
#: Bits that hold a position in a piece (two pieces' length and a little more).
PLACE_BITS = 18
#: Up to this many variants of a gram are compared in pairs by known prefixes; more are grouped by their windows.
FEW = 4

_TABLE = np.random.RandomState(7).randint(0, 2**63, 256, dtype=np.int64).astype(np.uint64)
_M = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(buf: np.ndarray) -> np.ndarray:
    """Hash of the 20 bytes from every position, by doubling."""
    def join(a, b, skip, power):
        n = len(b) - skip
        return a[:n] * power + b[skip:]

    with np.errstate(over="ignore"):
        h = _TABLE[buf]
        m = [_M]
        for _ in range(4):
            m.append(m[-1] * m[-1])
        h2 = join(h, h, 1, m[0])
        h4 = join(h2, h2, 2, m[1])
        h8 = join(h4, h4, 4, m[2])
        h16 = join(h8, h8, 8, m[3])
        h = join(h16, h4, 16, m[2])
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return h ^ (h >> np.uint64(29))


def anchors_of_windows(h: np.ndarray) -> np.ndarray:
    """Position of the leftmost least gram hash of every window, by doubling.

    Hash and position share one number (positions below ``2**PLACE_BITS``), so ties go to the left.
    """
    place = np.uint64((1 << PLACE_BITS) - 1)
    low = (h & ~place) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        low = np.minimum(low[width:], low[:-width])
        width *= 2
    if width < SPAN:
        low = np.minimum(low[SPAN - width:], low[:width - SPAN])
    return (low & place).astype(np.int64)


def packs(texts: list[bytes]) -> Iterator[tuple[np.ndarray, bytes, np.ndarray, list[tuple[int, int, int, int]]]]:
    """Texts cut and joined into pieces: (gram hashes, bytes, anchor of every window, segments).

    A segment (text number, offset in it, begin, end) covers windows begin..end of the piece.
    """
    held: list[bytes] = []
    segments: list[tuple[int, int, int, int]] = []
    size = 0

    def flush():
        buf = b"".join(held)
        h = gram_hashes(np.frombuffer(buf, dtype=np.uint8))
        return h, buf, anchors_of_windows(h), list(segments)

    for number, raw in enumerate(texts):
        for offset in range(0, max(len(raw) - LENGTH + 1, 0), PIECE):
            part = raw[offset:offset + PIECE + LENGTH - 1]
            held.append(part)
            segments.append((number, offset, size, size + len(part) - LENGTH + 1))
            size += len(part)
            if size >= PIECE:
                yield flush()
                held.clear()
                segments.clear()
                size = 0
    if held:
        yield flush()


def _encode(text) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def anchor_rows(docs: DataFrame, parts: int) -> DataFrame:
    """(part, hashes, buckets, counts): per task and partition the anchor hashes of its documents, by bucket."""
    schema = "part int, hashes binary, buckets binary, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_h, held_b, size = [], [], 0

        def emit() -> pa.RecordBatch:
            h, b = np.concatenate(held_h), np.concatenate(held_b)
            p = (h % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((h, b, p))
            h, b, p = h[order], b[order], p[order]
            cut = np.nonzero(np.diff(p))[0] + 1
            rows = [[], [], [], []]
            for hs, bs, part in zip(np.split(h, cut), np.split(b, cut), p[np.concatenate([[0], cut])]):
                kinds, counts = np.unique(bs, return_counts=True)
                for col, x in zip(rows, (int(part), hs.tobytes(), kinds.astype(np.int32).tobytes(), counts.astype(np.int32).tobytes())):
                    col.append(x)
            return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32())] + [pa.array(r, pa.binary()) for r in rows[1:]],
                                              ["part", "hashes", "buckets", "counts"])

        for batch in batches:
            bucket = batch.column("bucket").to_numpy(zero_copy_only=False)
            texts = [_encode(t.as_py()) for t in batch.column("text")]
            for h, _, at, segments in packs(texts):
                for number, _, begin, end in segments:
                    spots = at[begin:end]
                    found = np.unique(h[spots[np.concatenate([[True], spots[1:] != spots[:-1]])]])
                    held_h.append(found)
                    held_b.append(np.full(len(found), bucket[number], dtype=np.int32))
                    size += len(found)
                if size > 4_000_000:
                    yield emit()
                    held_h, held_b, size = [], [], 0
        if size:
            yield emit()

    return docs.select("bucket", "text").mapInArrow(run, schema)


def shared_anchors(rows: DataFrame) -> DataFrame:
    """(bucket, hashes): the anchor hashes of a bucket that at least two documents hold."""
    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        h = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in pdf["hashes"]])
        b = np.concatenate([np.repeat(np.frombuffer(k, dtype=np.int32), np.frombuffer(c, dtype=np.int32))
                            for k, c in zip(pdf["buckets"], pdf["counts"])])
        order = np.argsort(h, kind="stable")
        h, b = h[order], b[order]
        same = h[1:] == h[:-1]
        keep = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        h, b = h[keep], b[keep]
        order = np.argsort(b, kind="stable")
        h, b = h[order], b[order]
        kinds, starts = np.unique(b, return_index=True)
        return pd.DataFrame({"bucket": kinds.astype(np.int32),
                             "a": [np.unique(x).tobytes() for x in np.split(h, starts[1:])] if len(kinds) else []})

    return rows.groupBy("part").applyInPandas(meet, "bucket int, a binary")


def front_code(suffixes: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Shared prefix with the one before, length of the rest (a byte each), and the rests."""
    shared, rest, tails, last = bytearray(), bytearray(), [], b""
    for s in suffixes:
        n, i = min(len(s), len(last)), 0
        while i < n and s[i] == last[i]:
            i += 1
        shared.append(i)
        rest.append(len(s) - i)
        tails.append(s[i:])
        last = s
    return bytes(shared), bytes(rest), b"".join(tails)


def unfront(shared: bytes, rest: bytes, tails: bytes) -> list[bytes]:
    out, at, last = [], 0, b""
    for i, n in zip(shared, rest):
        last = last[:i] + tails[at:at + n]
        out.append(last)
        at += n
    return out


def merge_runs(runs: list[tuple[list[bytes], bytes]]) -> Iterator[tuple[int, int, int]]:
    """Loser-tree merge of sorted runs (strings, common prefix with the one before).

    Yields (run, index in it, common prefix with the string output before).
    """
    k = 1
    while k < len(runs):
        k *= 2
    now: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (k - len(runs))
    index, known, losers = [0] * k, [0] * k, [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); a loser that was compared gets its common prefix with the winner."""
        x, y = now[a], now[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        i = known[a]
        if i != known[b]:
            return (a, b) if i > known[b] else (b, a)
        n = min(len(x), len(y))
        while i < n and x[i] == y[i]:
            i += 1
        if i == n:
            first = (a, b) if (len(x), a) < (len(y), b) else (b, a)
        else:
            first = (a, b) if x[i] < y[i] else (b, a)
        known[first[1]] = i
        return first

    winners = list(range(k))
    node = k // 2
    while node:
        nxt = []
        for j in range(0, len(winners), 2):
            w, loser = play(winners[j], winners[j + 1])
            losers[node + j // 2] = loser
            nxt.append(w)
        winners, node = nxt, node // 2
    top = winners[0]
    while now[top] is not None:
        yield top, index[top], known[top]
        strings, shared = runs[top]
        index[top] += 1
        i = index[top]
        if i < len(strings):
            now[top], known[top] = strings[i], shared[i]
        else:
            now[top] = None
        node = (top + k) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2


RUN = "part int, bucket int, shared binary, rest binary, tails binary, lefts binary, left binary, doc binary, number binary, pos binary"


def runs_of_bucket(docs: pd.DataFrame, side: pd.DataFrame, parts: int, rows: DocumentRows) -> pd.DataFrame:
    """Front-coded runs of one bucket's shared anchor suffixes, one row per merge partition."""
    blobs = [np.frombuffer(a, dtype=np.uint64) for a in side["a"] if a is not None]
    shared = np.unique(np.concatenate(blobs)) if blobs else np.empty(0, np.uint64)
    names, numbers, texts, copies = rows(docs, side)
    orders = [names[n][0] for n in range(len(names))]
    found: list[dict[tuple[bytes, bytes], tuple[int, list[tuple[int, int]]]]] = [{} for _ in range(parts)]
    direct: list[tuple[int, int, int]] = []
    live = [n for n in range(len(names)) if n not in copies]
    if len(shared):
        for h, buf, at, segments in packs([texts[n] for n in live]):
            for number, offset, begin, end in segments:
                spots = at[begin:end]
                # windows with one anchor are neighbours: anchors never move left
                cut = np.concatenate([[0], np.nonzero(np.diff(spots))[0] + 1, [len(spots)]])
                where = spots[cut[:-1]]
                hs = h[where]
                near = np.minimum(np.searchsorted(shared, hs), len(shared) - 1)
                for j in np.nonzero(shared[near] == hs)[0]:
                    a, lo, hi = int(where[j]), begin + int(cut[j]), begin + int(cut[j + 1])
                    key = (buf[a:hi - 1 + LENGTH], buf[lo:a])
                    n = live[number]
                    doc, spot = orders[n], (n, offset + a - begin)
                    runs = found[int(hs[j] % np.uint64(parts))]
                    held = runs.get(key)
                    if held is None:
                        runs[key] = (doc, [spot])
                    elif doc == held[0]:  # the same text again in one document: every place needs its verdict
                        held[1].append(spot)
                    else:  # the smaller doc_id stays for the merge, the other's windows are all repeats
                        gone = [spot] if doc > held[0] else held[1]
                        direct += [(g, pos - len(key[1]), pos + len(key[0])) for g, pos in gone]
                        if doc < held[0]:
                            runs[key] = (doc, [spot])
    bucket = int(docs["bucket"].iloc[0])
    out = []
    for part, runs in enumerate(found):
        if runs:
            entries = [(k, runs[k][0], spot) for k in sorted(runs) for spot in runs[k][1]]
            keys, vals = [e[0] for e in entries], [(e[1], *e[2]) for e in entries]
            pre, rest, tails = front_code([k[0] for k in keys])
            out.append((part, bucket, pre, rest, tails, bytes(len(k[1]) for k in keys), b"".join(k[1] for k in keys),
                        np.array([v[0] for v in vals], np.int64).tobytes(), np.array([v[1] for v in vals], np.int32).tobytes(),
                        np.array([v[2] for v in vals], np.int64).tobytes()))
    if direct:  # ranges already decided pass a merge partition unmerged, so the runs are read once
        d = np.array(direct, dtype=np.int64)
        out.append((bucket % parts, bucket, None, None, None, None, None, None, d[:, 0].astype(np.int32).tobytes(), d[:, 1:].tobytes()))
    return pd.DataFrame(out, columns=[c.split()[0] for c in RUN.split(", ")])


class DocumentRows:
    """Distinct (doc order, text hash) of a bucket in a fixed order, with texts and which are whole copies."""

    def __call__(self, docs: pd.DataFrame, side: pd.DataFrame):
        names = sorted(set(zip(docs["doc"].tolist(), docs["digest"].tolist())))
        number = {name: i for i, name in enumerate(names)}
        numbers = [number[name] for name in zip(docs["doc"].tolist(), docs["digest"].tolist())]
        texts = [b""] * len(names)
        for i, text in zip(numbers, docs["text"]):
            texts[i] = _encode(text)
        copies = {number[name] for name in zip(side["doc"].tolist(), side["digest"].tolist()) if name in number}
        return names, numbers, texts, copies


def decide(group: list[tuple[bytes, bytes, int, int, int, int]], shared: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """Repeated ranges (bucket, number, begin, end) among suffixes with a common gram.

    ``group`` holds (right, left, doc, bucket, number, pos) in merged order, ``shared`` the common prefix of each
    right part with the one before.
    """
    least: dict[tuple[bytes, bytes], int] = {}
    for right, left, doc, *_ in group:
        key = (right, left)
        if doc < least.get(key, doc + 1):
            least[key] = doc
    variants, prefix, low = [], [], LENGTH + 1
    done = set()
    for item, pre in zip(group, shared):
        right, left, doc, bucket, number, pos = item
        low = min(low, pre)
        if doc > least[right, left]:
            yield bucket, number, pos - len(left), pos + len(right)
            continue
        variants.append(item)
        prefix.append(low)
        low = LENGTH + 1
        done.add((right, left))
    if len(done) < 2:
        return
    if len(variants) <= FEW:
        for x, (right, left, doc, bucket, number, pos) in enumerate(variants):
            first = LENGTH - len(right)
            hits = []
            for y, (_, other, smaller, *_) in enumerate(variants):
                if smaller >= doc:
                    continue
                common = min(prefix[min(x, y) + 1:max(x, y) + 1])
                back, n = 0, min(len(left), len(other))
                while back < n and left[-1 - back] == other[-1 - back]:
                    back += 1
                lo = max(first, LENGTH - common)
                if lo <= back:
                    hits.append((lo, back))
            for lo, hi in hits:
                yield bucket, number, pos - hi, pos - lo + LENGTH
        return
    owner: dict[tuple[bytes, bytes], int] = {}
    windows = []
    for right, left, doc, *_ in variants:
        mine = [(left[len(left) - i:], right[:LENGTH - i]) for i in range(LENGTH - len(right), len(left) + 1)]
        windows.append(mine)
        for w in mine:
            if doc < owner.get(w, doc + 1):
                owner[w] = doc
    for (right, left, doc, bucket, number, pos), mine in zip(variants, windows):
        first, begin = LENGTH - len(right), None
        for i, w in enumerate([*mine, None]):
            hit = w is not None and owner[w] < doc
            if hit and begin is None:
                begin = i
            elif not hit and begin is not None:
                yield bucket, number, pos - (first + i - 1), pos - (first + begin) + LENGTH
                begin = None


def merged_ranges(pdf: pd.DataFrame) -> pd.DataFrame:
    """Merge one partition's runs and return repeated ranges by bucket; rows without a run are decided ranges."""
    runs, meta = [], []
    decided = pdf["shared"].isna()
    rows = list(pdf.loc[decided, ["bucket", "number", "pos"]].itertuples(index=False, name=None))
    for r in pdf[~decided].sort_values("bucket").itertuples():
        strings = unfront(r.shared, r.rest, r.tails)
        runs.append((strings, r.shared))
        lefts, at = [], 0
        for n in r.lefts:
            lefts.append(r.left[at:at + n])
            at += n
        meta.append((r.bucket, lefts, np.frombuffer(r.doc, np.int64).tolist(), np.frombuffer(r.number, np.int32).tolist(),
                     np.frombuffer(r.pos, np.int64).tolist()))
    out: dict[int, list[tuple[int, int, int]]] = {}
    group: list = []
    shared: list[int] = []

    def close() -> None:
        if len(group) > 1:
            for bucket, number, begin, end in decide(group, shared):
                out.setdefault(bucket, []).append((number, begin, end))

    for run, i, pre in merge_runs(runs):
        bucket, lefts, doc, number, pos = meta[run]
        if pre < GRAM:
            close()
            group, shared = [], []
        group.append((runs[run][0][i], lefts[i], doc[i], bucket, number[i], pos[i]))
        shared.append(pre)
    close()
    rows += [(b, np.array([x[0] for x in v], np.int32).tobytes(), np.array([x[1:] for x in v], np.int64).tobytes()) for b, v in out.items()]
    return pd.DataFrame(rows, columns=["bucket", "number", "pos"])


def union(ranges: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by (begin, end) ranges; ranges that touch are one run."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(map(tuple, ranges.tolist())):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def remove_repeats(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, with_bytes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) for every row of ``docs``.

    Null texts are empty.  A null doc_id is larger than any other; rows with equal doc_ids (repeated rows
    among them) do not remove from one another.  Texts under 50 bytes keep everything.  An empty table gives an
    empty result.  Columns other than doc_id and text are not read.
    """
    last = 2**63 - 1
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(last)).alias("doc"),
                       F.unhex(F.md5(raw)).alias("digest"), "text")
    slim = materialize(rows.select("doc", "digest", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("size")))
    total = slim.agg(F.sum("size")).first()[0] or 0
    parts = max(1, ceil(total / bucket_bytes))
    bucket = F.pmod(F.xxhash64("doc", "digest"), F.lit(parts)).cast("int")
    rows = rows.withColumn("bucket", bucket)
    # whole copies: equal texts of 50 bytes or more with a larger doc_id
    firsts = slim.filter(F.col("size") >= LENGTH).groupBy("digest").agg(F.min("doc").alias("m"), F.max("doc").alias("x")).filter("m < x")
    copies = slim.filter(F.col("size") >= LENGTH).join(firsts, "digest").filter("doc > m").select("doc", "digest").distinct()
    copies = materialize(copies.withColumn("bucket", bucket))
    none = F.lit(None).cast("binary")
    known = copies.select("bucket", "doc", "digest", none.alias("a"), none.alias("number"), none.alias("pos"))

    shared = shared_anchors(anchor_rows(rows, parts)).select(
        "bucket", F.lit(None).cast("bigint").alias("doc"), none.alias("digest"), "a", none.alias("number"), none.alias("pos"))
    named = DocumentRows()

    def make_runs(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame([], columns=[c.split()[0] for c in RUN.split(", ")])
        return runs_of_bucket(left, right, parts, named)

    # one plan from here on: the texts are dealt to their buckets once and that exchange is read by both cogroups
    texts = rows.select("bucket", "doc", "digest", "text")
    runs = texts.groupBy("bucket").cogroup(shared.unionByName(known).groupBy("bucket")).applyInPandas(make_runs, RUN)
    ranges = runs.groupBy("part").applyInPandas(merged_ranges, "bucket int, number binary, pos binary")
    ranges = ranges.select("bucket", F.lit(None).cast("bigint").alias("doc"), none.alias("digest"), none.alias("a"), "number", "pos")

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if with_bytes else "")
    columns = [c.split()[0] for c in schema.split(", ")]

    def cut(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left):
            names, numbers, texts, copied = named(left, right[right["doc"].notna()])
            sent = [(np.frombuffer(n, np.int32), np.frombuffer(p, np.int64).reshape(-1, 2))
                    for n, p in zip(right["number"], right["pos"]) if n is not None]
            who = np.concatenate([s[0] for s in sent]) if sent else np.empty(0, np.int32)
            where = np.concatenate([s[1] for s in sent]) if sent else np.empty((0, 2), np.int64)
            order = np.argsort(who, kind="stable")
            who, where = who[order], where[order]
            at = np.searchsorted(who, np.arange(len(names) + 1))
            results = []
            for i, text in enumerate(texts):
                spans = [(0, len(text))] if i in copied else union(where[at[i]:at[i + 1]])
                kept, pos = [], 0
                for begin, end in spans:
                    kept.append(text[pos:begin])
                    pos = end
                kept = b"".join([*kept, text[pos:]])
                results.append((len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept)[:5 if with_bytes else 4])
            out = [(None if d == last else d, *results[i]) for d, i in zip(left["doc"].tolist(), numbers)]
        frame = pd.DataFrame(out, columns=columns)
        return frame.astype({"doc_id": "Int64"})

    side = ranges.unionByName(known)
    return texts.groupBy("bucket").cogroup(side.groupBy("bucket")).applyInPandas(cut, schema)


def op3_suffix_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, removed bytes and runs, and digest of the rest of every document."""
    return remove_repeats(documents(spark, sf_dir))


QUERIES = {"op3_suffix_merge_dedup": op3_suffix_merge_dedup}
ORACLE: dict[str, str] = {}

"""Byte-level BPE encoding and decoding: a fold of ranked merges over distinct pieces.

Text is cut into pieces by the tokenizer's pattern.  A task encodes each distinct piece once (until its
store of pieces is full): its bytes become single-byte token ids and a fold applies ranked merges until no
adjacent pair has a rank.  The rank map gives the id of the joined bytes for a pair (a, b) of ids, by a
perfect hash, so that a look-up reads two numbers, the shift of the pair's bucket and a cell that holds the
pair and the joined id (the id of a token is its rank).  It is sent to the tasks once and is no part of any
plan.  Every token of the public vocabularies is the result of merging its own bytes, so whole pieces need
no second table.

The fold works on all new pieces of a batch at once, as arrays: a step merges in every piece the leftmost
pair of lowest rank and looks up the two pairs that this makes; pieces without a ranked pair leave.  Long
pieces take the same merges one by one from a heap, so that their cost grows with n log n.

Decoding concatenates the bytes of the ids.  Nothing is shuffled, and a document's own ids are addressed by
position in the task's store of pieces.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcube.llm.common import documents

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Largest vocabulary, buckets and places (powers of two) of the rank map, and multipliers of its hashes.
VOCABULARY_MAX, BUCKETS, PLACES = 65_536, 1 << 16, 1 << 18
MIX = (40_503, 30_671, 60_493, 19_937)
#: Stands for "no rank".
NONE = 1 << 20
#: Pieces of at most this many bytes are folded as arrays, longer ones by a heap (the ids are the same).
SHORT = 128
#: Characters of text that are cut, folded and given out together (a longer document goes alone).
CHUNK_CHARS = 2_000_000
#: Pieces that a task remembers before it starts anew.
PIECES_MAX = 300_000


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank; ranks must be 0..n-1."""
    with open(path, "rb") as f:
        pairs = sorted((int(r), base64.b64decode(t)) for t, r in (line.split() for line in f if line.strip()))
    if [r for r, _ in pairs] != list(range(len(pairs))) or len(pairs) >= VOCABULARY_MAX:
        raise ValueError("ranks must be 0..n-1 with n at most 65,535")
    return [t for _, t in pairs]


def placed(a: list[int], b: list[int], joined: list[int]) -> tuple[list[int], list[int]]:
    """A perfect hash of the distinct pairs (hash and displace): shift by bucket, and by place the cell (a, b, joined id) or -1.

    Buckets are placed largest first; each tries shifts in order until all its places are free.
    """
    a, b, joined = (np.array(x, dtype=np.int64) for x in (a, b, joined))
    bucket, spot = (a * MIX[0] + b * MIX[1]) % BUCKETS, a * MIX[2] + b * MIX[3]
    order = np.argsort(bucket, kind="stable")
    groups = np.split(order, np.nonzero(np.diff(bucket[order]))[0] + 1)
    cells, shift = np.full(PLACES, -1, np.int64), np.zeros(BUCKETS, np.int64)
    for group in sorted(groups, key=len, reverse=True):
        for d in range(PLACES):
            at = (spot[group] + d) % PLACES
            if (cells[at] < 0).all() and len(set(at.tolist())) == len(at):
                break
        else:
            raise ValueError("no free places for a bucket")
        shift[bucket[group[0]]] = d
        cells[at] = (a[group] * VOCABULARY_MAX + b[group]) * NONE + joined[group]
    return shift.tolist(), cells.tolist()


class RankMap(NamedTuple):
    """``shift`` by bucket, ``cells`` by place, ids of the 256 ``bytes``."""

    shift: np.ndarray
    cells: np.ndarray
    bytes: np.ndarray


@lru_cache(maxsize=4)
def rank_map(vocabulary: str) -> RankMap:
    """The rank map of a vocabulary, made once on the driver; a function that refers to it takes it to the tasks."""
    tokens = read_ranks(vocabulary)
    rank = {t: i for i, t in enumerate(tokens)}
    left, right, joined = [], [], []
    for c, token in enumerate(tokens):
        for cut in range(1, len(token)):
            a, b = rank.get(token[:cut]), rank.get(token[cut:])
            if a is not None and b is not None:
                left.append(a), right.append(b), joined.append(c)
    shift, cells = placed(left, right, joined)
    return RankMap(np.array(shift, np.int64), np.array(cells, np.int64), np.array([rank[bytes([b])] for b in range(256)], np.int64))


def rank_of(a: np.ndarray, b: np.ndarray, ranks: RankMap) -> np.ndarray:
    """Ranks of adjacent pairs of ids (the id of the joined bytes); NONE without one."""
    shift = ranks.shift[(a * MIX[0] + b * MIX[1]) & (BUCKETS - 1)]
    cell = ranks.cells[(a * MIX[2] + b * MIX[3] + shift) & (PLACES - 1)]
    return np.where(cell >> 20 == a * VOCABULARY_MAX + b, cell & (NONE - 1), NONE)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of all elements of the stretches that begin at ``starts`` and hold ``sizes`` elements."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def merge_short(ids: np.ndarray, sizes: np.ndarray, ranks: RankMap) -> tuple[np.ndarray, np.ndarray]:
    """Ids and sizes of pieces (none empty, one after another) after all ranked merges.

    A step merges the leftmost pair of lowest rank of every piece that has one.  A pair's number is rank << 32 | place of
    its first id, so that pair is the piece's least number.
    """
    out, out_sizes, piece = [], np.zeros(len(sizes), np.int64), np.arange(len(sizes))
    rank = np.full(len(ids), NONE, np.int64)  # of an id with the next of its piece
    rank[:-1] = rank_of(ids[:-1], ids[1:], ranks)
    rank[np.cumsum(sizes) - 1] = NONE
    while len(piece):
        low = np.minimum.reduceat((rank << 32) + np.arange(len(ids)), np.cumsum(sizes) - sizes)
        at, low = low & 0xFFFFFFFF, low >> 32
        more = low < NONE
        if not more.all():  # pieces without a ranked pair leave
            stay = np.repeat(more, sizes)
            out.append((piece[~more], ids[~stay]))
            out_sizes[piece[~more]] = sizes[~more]
            at = (at - np.cumsum(~stay)[at])[more]
            ids, rank, piece, sizes, low = ids[stay], rank[stay], piece[more], sizes[more], low[more]
        ids[at] = low
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        ids, rank, sizes = ids[keep], rank[keep], sizes - 1
        at = at - np.arange(len(at))  # each piece before lost one id
        ends = np.cumsum(sizes)
        rank[at] = NONE
        for first in (at[at < ends - 1], at[at > ends - sizes] - 1):
            rank[first] = rank_of(ids[first], ids[first + 1], ranks)
    starts, merged = np.cumsum(out_sizes) - out_sizes, np.empty(out_sizes.sum(), np.int64)
    for pieces, found in out:
        merged[spread(starts[pieces], out_sizes[pieces])] = found
    return merged, out_sizes


def merge_long(ids: np.ndarray, ranks: RankMap) -> list[int]:
    """Ids of one piece after all ranked merges, the same as ``merge_short``, by a heap of pairs."""
    def pair(a: int, b: int) -> int:
        cell = int(ranks.cells[(a * MIX[2] + b * MIX[3] + int(ranks.shift[(a * MIX[0] + b * MIX[1]) & (BUCKETS - 1)])) & (PLACES - 1)])
        return cell & (NONE - 1) if cell >> 20 == a * VOCABULARY_MAX + b else NONE

    rank, ids, n = [*rank_of(ids[:-1], ids[1:], ranks).tolist(), NONE], ids.tolist(), len(ids)
    after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
    heap = [(r << 32) + i for i, r in enumerate(rank) if r < NONE]
    heapify(heap)
    while heap:
        number = heappop(heap)
        low, at = number >> 32, number & 0xFFFFFFFF
        if gone[at] or rank[at] != low:  # of a pair that is no more
            continue
        right = after[at]
        ids[at], gone[right], after[at] = low, True, after[right]
        if after[at] < n:
            before[after[at]] = at
        for first in (at, before[at]):
            if first >= 0:
                second = after[first]
                rank[first] = pair(ids[first], ids[second]) if second < n else NONE
                if rank[first] < NONE:
                    heappush(heap, (rank[first] << 32) + first)
    return [x for x, left in zip(ids, gone) if not left]


def merge_words(words: list[str], ranks: RankMap) -> tuple[np.ndarray, np.ndarray]:
    """Ids and their number of pieces (none empty), one after another."""
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    ids, short = ranks.bytes[np.frombuffer(b"".join(raw), np.uint8)], sizes <= SHORT
    starts = np.cumsum(sizes) - sizes
    merged, lengths = merge_short(ids[np.repeat(short, sizes)], sizes[short], ranks)
    if short.all():
        return merged, lengths
    long = [merge_long(ids[s:s + n], ranks) for s, n in zip(starts[~short].tolist(), sizes[~short].tolist())]
    sizes[short], sizes[~short] = lengths, [len(x) for x in long]
    out, of_short = np.empty(sizes.sum(), np.int64), np.repeat(short, sizes)
    out[of_short], out[~of_short] = merged, np.concatenate([np.array(x, np.int64) for x in long])
    return out, sizes


class Pieces(dict):
    """Numbers of the pieces that a task has met, and their ids (``start`` and ``size`` by number)."""

    def __init__(self, ranks: RankMap):
        super().__init__()
        self.ranks, self.new = ranks, []
        self.ids, self.start, self.size = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = number = len(self)
        return number

    def fold(self) -> None:
        """Encode the pieces met since the last call."""
        ids, size = merge_words(self.new, self.ranks)
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.ids, self.size, self.new = np.concatenate([self.ids, ids.astype(np.int32)]), np.concatenate([self.size, size]), []


def encode(docs: DataFrame, vocabulary: str, keep: list[str], pattern: str = public_tokenizers.PATTERN,
           chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``keep`` columns of ``docs`` and ``ids``: token ids of the whole text, as array<int>.

    Null text is empty and gives no ids; each row is encoded on its own, so repeated rows and ties do
    not matter; an empty table gives an empty result; text within a piece may have any length.
    ``keep`` must not contain a column named ``ids``.
    """
    ranks = rank_map(vocabulary)
    schema = T.StructType([*[T.StructField(c, docs.schema[c].dataType) for c in keep], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split, pieces = regex.compile(pattern, regex.V1).findall, Pieces(ranks)

        def encoded(part: pa.RecordBatch, coded: list[np.ndarray]) -> pa.RecordBatch:
            pieces.fold()
            codes = np.concatenate(coded)
            sizes = pieces.size[codes]
            ids = pieces.ids[spread(pieces.start[codes], sizes)]
            ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum([len(c) for c in coded])])]
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
            return pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], lists], [*keep, "ids"])

        for batch in batches:
            texts, begin, coded, held = batch.column("text"), 0, [], 0
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                coded.append(np.array([pieces[w] for w in split(text)], dtype=np.int32))
                held += len(text)
                if held >= chunk_chars or i + 1 == batch.num_rows:
                    yield encoded(batch.slice(begin, i + 1 - begin), coded)
                    begin, coded, held = i + 1, [], 0
                    if len(pieces) > PIECES_MAX:
                        pieces = Pieces(ranks)

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def _lists(ids: pa.Array) -> Iterator[np.ndarray | None]:
    """The id arrays of a column, without nulls within; None for a null."""
    values, ends = ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False), np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    for end, size, known in zip(ends.tolist(), np.diff(ends, prepend=0).tolist(), ids.is_valid().to_pylist()):
        yield values[end - size:end] if known else None


def packed(ids: Column) -> Column:
    """An id array as little-endian unsigned 32-bit integers, as binary."""
    @F.arrow_udf("binary")
    def pack(ids: pa.Array) -> pa.Array:
        return pa.array([None if x is None else x[x >= 0].astype("<u4").tobytes() for x in _lists(ids)], pa.binary())

    return pack(ids)


def decode(ids: Column, vocabulary: str) -> Column:
    """Bytes of a token id array."""
    tokens = read_ranks(vocabulary)

    @F.arrow_udf("binary")
    def join(ids: pa.Array) -> pa.Array:
        known = lambda x: x[(x >= 0) & (x < len(tokens))].tolist()
        return pa.array([None if x is None else b"".join(map(tokens.__getitem__, known(x))) for x in _lists(ids)], pa.binary())

    return join(ids)


def op6_bpe_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and of the decoded bytes, for every document."""
    path = public_tokenizers.path(VOCABULARY)
    out = encode(documents(spark, sf_dir).select("doc_id", "text"), path, ["doc_id"])
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(packed(F.col("ids")), 256).alias("ids_sha256"),
                      F.sha2(decode(F.col("ids"), path), 256).alias("decoded_sha256"))


QUERIES = {"op6_bpe_fold": op6_bpe_fold}
ORACLE: dict[str, str] = {}

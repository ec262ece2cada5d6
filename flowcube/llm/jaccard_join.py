"""Exact n-gram Jaccard join by a size-aware heavy-light split.

A document is the set of its distinct word shingles, as 64-bit hashes.  Length of the shingles and threshold are
arguments; the numbers below are those of op7 (4 words, 0.85), the default.
Documents with equal sets form a class; classes are joined, copies are not.

* Light sets (at most x shingles): two sets of sizes a and b link if they share
  o(a, b) = ceil(85 (a + b) / 185) elements, i.e. if they share one subset of that size.  Every
  light set enumerates its subsets of the few sizes that its possible partners ask for; sets that
  meet in a subset link, and a star around the smallest of them holds all their links.
* Heavy sets: inverted lists over each set's prefix (the rarest n - ceil(.85 n) + 1
  shingles; linked sets share one of them).  Rarity comes from a fixed-size count sketch
  over all documents, so passages that many documents share stand last.
  A list is scanned in two rounds.  First every member is compared with
  the list's hubs, which joins large groups of near copies with few comparisons.  Then
  only members of different components are compared, the list's largest
  component never with itself.  Candidates pass size and position filters, a parity
  sketch whose distance bounds the symmetric difference (for large sets a second one, as fine as
  the set is large), and the exact count.

The boundary x has the least cost: subsets of light sets against postings of heavy
ones times the expected list length, from the sizes of all sets and the sketch.
Result components are exact: a pair is left out only when it cannot link or is connected already.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcube.llm.common import documents
from flowcube.llm.graph import components
from flowcube.operators.materialize import materialize

#: Words of a shingle, of op7.
WORDS = 4
#: Two sets link when 100 * intersection >= LINK * union, of op7.
LINK = 85
#: Counters of the shingle count sketch (4 bytes each, whatever the corpus size), in BLOCKS pieces.
SKETCH_BITS, BLOCKS = 18, 4
#: Largest size that may be light; the boundary is chosen below it.
LIGHT_MAX = 40
#: Hubs each set is verified against in the first round (the second round is exact for the rest).
HUBS = 3
#: 64-bit words of the parity sketch.
PARITY = 8
#: Bits of the map of documents whose sets are compared (1 MB).
BITMAP_BITS = 1 << 23

_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                  0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def need(a: int, b: int, link: int = LINK) -> int:
    """Least intersection of linked sets of sizes a and b."""
    return -(-link * (a + b) // (100 + link))


def finish(h: np.ndarray) -> np.ndarray:
    """Avalanche 64-bit values."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class WordHashes(dict):
    """Hash of a word, computed once; emptied when it is full."""

    def __init__(self):
        import xxhash
        super().__init__()
        self.digest = xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = self.digest(word)
        return value


class Hasher:
    """Shingle sets of texts."""

    def __init__(self, words: int = WORDS):
        if not 1 <= words <= len(_MULT):
            raise ValueError(f"a shingle has 1 to {len(_MULT)} words")
        self.hash, self.words = WordHashes().__getitem__, words

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit shingle hashes of a text."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        n = len(words)
        h = np.fromiter(map(self.hash, words), np.uint64, n)
        if n == 0:
            return h
        k = self.words
        if n < k:
            total = np.uint64(n)
            for i in range(n):
                total = total * _MULT[1] + h[i] * _MULT[0]
            return finish(np.array([total], dtype=np.uint64))
        total = h[:n - k + 1] * _MULT[0]
        for i in range(1, k):
            total += h[i:n - k + 1 + i] * _MULT[i]
        total = finish(total)
        total.sort()
        return total[np.concatenate([[True], total[1:] != total[:-1]])]


def set_node(h: np.ndarray) -> int:
    """Signed 64-bit identity of a shingle set."""
    import xxhash
    return xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63)


def parity_bits(h: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles in each of 64 * PARITY cells, as 64-bit words."""
    odd = np.bincount((finish(h + np.uint64(7)) >> np.uint64(64 - 6 - PARITY.bit_length() + 1)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def fine_bits(h: np.ndarray) -> bytes | None:
    """Parity sketch of a large set with as many cells as shingles or more, a power of two; the first sketch does for the others."""
    if len(h) <= 64 * PARITY:
        return None
    cells = 1 << (len(h) - 1).bit_length()
    odd = np.bincount((finish(h + np.uint64(7)) & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def fine_distance(a: bytes, b: bytes) -> int:
    """Differing cells of two sketches, the longer one folded to the cells of the other: at most the sets' symmetric difference."""
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    if len(x) < len(y):
        x, y = y, x
    x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.unpackbits(x ^ y).sum())


def text_id() -> Column:
    """Identity of a row's text: doc_id may be null or repeated."""
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def profiles(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per document (doc_id, text_id, n, node, parity, fine), and per task its sketch blocks (block, counts)."""
    schema = "doc_id bigint, text_id binary, n bigint, node bigint, parity array<bigint>, fine binary, block int, counts binary"
    names = ["doc_id", "text_id", "n", "node", "parity", "fine", "block", "counts"]
    bits = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, sketch = Hasher(words), np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in batches:
            n, node, parity, fine, cells = [], [], [], [], [np.empty(0, np.int64)]
            with np.errstate(over="ignore"):
                for text in batch.column("text"):
                    h = hasher.shingles(text.as_py())
                    n.append(len(h))
                    node.append(set_node(h) if len(h) else None)
                    parity.append(parity_bits(h))
                    fine.append(fine_bits(h))
                    cells.append((h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64))
            sketch += np.bincount(np.concatenate(cells), minlength=len(sketch)).astype(np.uint32)
            k = len(n)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_id"), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                                              pa.array(parity, bits), pa.array(fine, pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names)
        if sketch.any():
            parts = np.split(sketch, BLOCKS)
            yield pa.RecordBatch.from_arrays([pa.nulls(BLOCKS, pa.int64()), pa.nulls(BLOCKS, pa.binary())] + [pa.nulls(BLOCKS, pa.int64())] * 2 + [
                pa.nulls(BLOCKS, bits), pa.nulls(BLOCKS, pa.binary()), pa.array(range(BLOCKS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_id().alias("text_id"), "text").mapInArrow(run, schema)


def sketch_total(table: DataFrame) -> np.ndarray:
    """Sum of the tasks' sketches; the driver receives its 2**SKETCH_BITS counters only."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum((np.frombuffer(b, dtype=np.uint32).astype(np.uint64) for b in pdf["counts"]),
                    np.zeros((1 << SKETCH_BITS) // BLOCKS, dtype=np.uint64))
        total = np.minimum(total, np.uint64(2**32 - 1)).astype(np.uint32)
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "counts": [total.tobytes()]})

    rows = table.filter("block is not null").select("block", "counts")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("counts"), F.lit(32)))
    some = rows.groupBy("block", "part").applyInPandas(add, "block int, counts binary")
    got = {r["block"]: r["counts"] for r in some.groupBy("block").applyInPandas(add, "block int, counts binary").collect()}
    empty = bytes((4 << SKETCH_BITS) // BLOCKS)
    return np.concatenate([np.frombuffer(got.get(b, empty), dtype=np.uint32) for b in range(BLOCKS)])


def subset_sizes(n: int, x: int, link: int = LINK) -> list[int]:
    """Subset sizes a light set of n shingles enumerates for partners of at most x."""
    return sorted({need(n, b, link) for b in range(-(-link * n // 100), min(x, n * 100 // link) + 1)})


def prefix_length(n: int, link: int = LINK) -> int:
    return n - -(-link * n // 100) + 1


def boundary(sizes: dict[int, int], sketch: np.ndarray, link: int = LINK) -> int:
    """The light boundary x of least cost; ``sizes`` counts sets by size up to LIGHT_MAX."""
    c = sketch.astype(np.float64)
    total = max(c.sum(), 1.0)
    lists = max(0.0, (float((c * c).sum()) - total * total / len(c)) / total)
    heavy = {n: sizes.get(n, 0) * prefix_length(n, link) * (1 + lists) for n in range(1, LIGHT_MAX + 1)}
    light = lambda n, x: sizes.get(n, 0) * sum(comb(n, o) for o in subset_sizes(n, x, link))
    costs = [sum(light(n, x) if n <= x else heavy[n] for n in heavy)
             + sum(heavy[n] for n in heavy if n <= x and 100 * n >= link * (x + 1)) for x in range(LIGHT_MAX + 1)]
    return int(np.argmin(costs))


def signatures(docs: DataFrame, sketch: np.ndarray, x: int, words: int = WORDS, link: int = LINK) -> DataFrame:
    """(light, token, node, n, pos): subset hashes of light sets (pos = subset size) and prefixes of the others."""
    schema = "light boolean, token bigint, node bigint, n int, pos int"

    def subsets(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, tokens, sizes = len(h), [], []
        g = finish(h + np.uint64(1))
        total = g.sum(dtype=np.uint64)
        for o in subset_sizes(n, x, link):
            drop = list(combinations(range(n), n - o))
            gone = g[np.array(drop, dtype=np.int64)].sum(axis=1, dtype=np.uint64) if n > o else np.zeros(1, np.uint64)
            tokens.append(finish(total - gone + np.uint64(o) * _MULT[2]))
            sizes.append(np.full(len(drop), o, dtype=np.int32))
        return np.concatenate(tokens), np.concatenate(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, done = Hasher(words), set()
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]

            def add(light: bool, tokens: np.ndarray, node: int, n: int, pos: np.ndarray) -> None:
                k = len(tokens)
                for part, a in zip(out, (np.full(k, light), tokens.view(np.int64), np.full(k, node, dtype=np.int64),
                                         np.full(k, n, dtype=np.int32), pos.astype(np.int32))):
                    part.append(a)

            with np.errstate(over="ignore"):
                for text in batch.column("text"):
                    h = hasher.shingles(text.as_py())
                    n = len(h)
                    node = set_node(h) if n else None
                    if node is None or node in done:  # copies within a task are signed once
                        continue
                    done.add(node)
                    if n <= x:
                        tokens, pos = subsets(h)
                        add(True, tokens, node, n, pos)
                    if n > x or 100 * n >= link * (x + 1):
                        rare = sketch[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                        k = prefix_length(n, link)
                        add(False, h[np.lexsort((h, rare))[:k]], node, n, np.arange(k))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)) for a in out],
                                                 ["light", "token", "node", "n", "pos"])

    return docs.select("text").mapInArrow(run, schema)


def slot_of(*row) -> Column:
    return F.pmod(F.xxhash64(*row), F.lit(BITMAP_BITS))


def wanted_bits(wanted: DataFrame) -> np.ndarray:
    """Bitmap of hashed rows (doc_id, text_id); the driver receives its BITMAP_BITS bits only, whatever the number of documents."""
    slots = wanted.select((slot_of("doc_id", "text_id") + 1).alias("slot"))
    rows = slots.groupBy(F.bitmap_bucket_number("slot").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    out = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    for r in rows:
        at = (r["b"] - 1) * len(r["bits"])
        out[at:at + len(r["bits"])] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return out


def shingle_sets(docs: DataFrame, wanted: DataFrame, words: int = WORDS) -> DataFrame:
    """(node, shingles) of the wanted rows (doc_id, text_id).

    Rows are told apart by the bitmap, so no text is shuffled; a few others may pass it, which only adds
    sets that nothing refers to.
    """
    bits = wanted_bits(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, done = Hasher(words), set()
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            rows = np.nonzero((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)[0]
            with np.errstate(over="ignore"):
                found = [hasher.shingles(batch.column("text")[i].as_py()) for i in rows.tolist()]
            found = {set_node(h): h for h in found if len(h)}
            new = [node for node in found if node not in done]  # copies within a task are given once
            done.update(new)
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.int64()), pa.array([found[k].tobytes() for k in new], pa.binary())],
                                             ["node", "shingles"])

    def made(some: DataFrame) -> DataFrame:
        return some.select(slot_of("doc_id", text_id()).alias("slot"), "text").mapInArrow(run, "node bigint, shingles binary")

    # copies without a doc_id are the same row to the bitmap, in any number of tasks
    return made(docs.filter("doc_id is not null")).unionByName(made(docs.filter("doc_id is null")).dropDuplicates(["node"]))


def distance(a: str, b: str) -> str:
    """Differing parity bits of members ``a`` and ``b`` of a list."""
    return "(" + " + ".join(f"bit_count({a}.parity[{i}] ^ {b}.parity[{i}])" for i in range(PARITY)) + ")"


def close(a: str, b: str, link: int = LINK) -> str:
    """Condition on members ``a`` and ``b`` of a list (n, pos, parity): they may link by size, position and parity.

    From the first shared token of the order on, at most min(n - pos) elements are shared; and the sets' symmetric
    difference a + b - 2 |A and B| is at least the number of differing parity bits.
    """
    return (f"100 * least({a}.n, {b}.n) >= {link} * greatest({a}.n, {b}.n) "
            f"and {100 + link} * least({a}.n - {a}.pos, {b}.n - {b}.pos) >= {link} * ({a}.n + {b}.n) "
            f"and {100 + link} * ({a}.n + {b}.n - {distance(a, b)}) >= {2 * link} * ({a}.n + {b}.n)")


def near(pairs: DataFrame, classes: DataFrame, link: int = LINK) -> DataFrame:
    """Pairs (u, v) without those of two large sets whose fine sketches differ in more cells than linked sets can."""
    fine = classes.filter("fine is not null").select("node", "n", "fine")
    both = pairs.select("u", "v")
    for side in ("u", "v"):
        both = both.join(fine.select(F.col("node").alias(side), F.col("n").alias(f"{side}n"), F.col("fine").alias(f"{side}f")), side, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            may = []
            for a, b, x, y in zip(*[batch.column(c).to_pylist() for c in ("un", "vn", "uf", "vf")]):
                may.append(x is None or y is None or (100 + link) * (a + b - fine_distance(x, y)) >= 2 * link * (a + b))
            yield batch.select(["u", "v"]).filter(pa.array(may, pa.bool_()))

    return both.select("u", "v", "un", "vn", "uf", "vf").mapInArrow(run, "u bigint, v bigint")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int = WORDS, link: int = LINK) -> DataFrame:
    """Edges (u, v) among candidate pairs (u, v) that link, by the exact count; sets are made for these pairs only."""
    pairs = materialize(near(pairs, classes, link))
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    sets = materialize(shingle_sets(docs, nodes.join(classes, "node").select("rep.doc_id", "rep.text_id"), words))
    whole = pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("us")), "u")
    whole = whole.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("vs")), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = []
            for us, vs in zip(batch.column("us"), batch.column("vs")):
                a, b = np.frombuffer(us.as_buffer(), dtype=np.uint64), np.frombuffer(vs.as_buffer(), dtype=np.uint64)
                at = np.searchsorted(a, b)
                common = int((a[np.minimum(at, len(a) - 1)] == b).sum())
                hits.append((100 + link) * common >= link * (len(a) + len(b)))
            yield batch.select(["u", "v"]).filter(pa.array(hits, pa.bool_()))

    return whole.select("u", "v", "us", "vs").mapInArrow(run, "u bigint, v bigint")


def linked(docs: DataFrame, words: int = WORDS, link: int = LINK) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_id, n, node) of ``docs``, and classes (node, rep, comp) by shingles of ``words`` words and a
    Jaccard of ``link`` %.

    ``comp`` names a component of texts, whatever the doc_ids; ``rep`` (no_id, doc_id, text_id) is the class's first row.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    table = materialize(profiles(docs, words))
    sketch = sketch_total(table)
    rows = table.filter("block is null").select("doc_id", "text_id", "n", "node", "parity", "fine")
    classes = materialize(rows.filter("n > 0").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_id")).alias("rep"), F.max("n").alias("n"), F.first("parity").alias("parity"),
        F.first("fine").alias("fine")))
    sizes = {int(r["n"]): int(r["c"]) for r in classes.filter(f"n <= {LIGHT_MAX}").groupBy("n").agg(F.count("*").alias("c")).collect()}
    x = boundary(sizes, sketch) if link == LINK else boundary(sizes, sketch, link)

    signed = signatures(docs, sketch, x, words, link).repartition("token").dropDuplicates(["token", "node", "light"])
    by_size = Window.partitionBy("light", "token").orderBy("n", "node")
    # a member stays if its neighbour by size is near enough; then every list has two members or more
    signed = signed.withColumn("below", F.lag("n").over(by_size)).withColumn("above", F.lead("n").over(by_size))
    lists = materialize(signed.filter(f"100 * below >= {link} * n or 100 * n >= {link} * above").drop("below", "above"))

    light = lists.filter("light")
    least = Window.partitionBy("token")
    star = light.withColumn("hub", F.min(F.struct("n", "node")).over(least)).filter("node <> hub.node").filter(
        f"{100 + link} * pos >= {link} * (n + hub.n)").select(F.col("node").alias("u"), F.col("hub.node").alias("v"))

    heavy = lists.filter("not light").drop("light")
    members = materialize(heavy.join(classes.select("node", "parity"), "node"))
    # first round: every member against two hubs of its list, a pseudo-random one and one of least place: of near copies,
    # the one with the fewest shingles of its own (rare ones, which stand first) is the nearest to the others
    every, body = Window.partitionBy("token"), [F.xxhash64("token", "node").alias("by"), "node", "n", "pos", "parity"]
    hubs = members.withColumn("some", F.min(F.struct(*body)).over(every)).withColumn("first", F.min(F.struct(F.col("pos").alias("at"), *body)).over(every))
    hubs = hubs.withColumn("first", F.struct(*[F.col("first")[c].alias(c) for c in ("by", "node", "n", "pos", "parity")]))
    hubs = hubs.select("node", F.struct("n", "pos", "parity").alias("a"), F.explode(F.array("some", "first")).alias("b"))
    hubs = hubs.filter("node <> b.node").filter(close("a", "b", link))
    firsts = hubs.groupBy("node", F.col("b.node").alias("hub")).agg(F.count(F.lit(1)).alias("shared"), F.min(F.expr(distance("a", "b"))).alias("apart"))
    best = Window.partitionBy("node").orderBy("apart", F.desc("shared"), "hub")
    firsts = firsts.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= HUBS).select(
        F.col("node").alias("u"), F.col("hub").alias("v"))
    edges = materialize(star.unionByName(verified(firsts, docs, classes, words, link)))
    parts = materialize(components(edges))

    # second round: members of different components, never within a list's largest component
    tagged = members.join(parts, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    per = tagged.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c"))
    top = per.groupBy("token").agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("c", "comp")).alias("top")).filter(
        "comps > 1").select("token", F.col("top.comp").alias("main"))
    mixed = materialize(tagged.join(top, "token"))
    pairs = mixed.filter("comp <> main").alias("a").join(
        mixed.alias("b"), F.expr(f"a.token = b.token and a.comp <> b.comp and (b.comp = b.main or a.node < b.node) and {close('a', 'b', link)}"))
    pairs = pairs.select(F.expr("least(a.node, b.node)").alias("u"), F.expr("greatest(a.node, b.node)").alias("v")).distinct()
    # the second round's edges join components of the first: the small graph of components is enough
    name = lambda c, out: parts.select(F.col("node").alias(c), F.col("comp").alias(out))
    more = verified(pairs, docs, classes, words, link).join(name("u", "uc"), "u", "left").join(name("v", "vc"), "v", "left").select(
        F.coalesce("uc", "u").alias("u"), F.coalesce("vc", "v").alias("v"))
    joined = components(more).select(F.col("node").alias("comp"), F.col("comp").alias("whole"))

    of_node = classes.select("node", "rep").join(parts, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    of_node = of_node.join(joined, "comp", "left").select("node", "rep", F.coalesce("whole", "comp").alias("comp"))
    return rows, of_node


def join_documents(docs: DataFrame, words: int = WORDS, link: int = LINK) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``, by shingles of ``words`` words and a Jaccard of ``link`` %.

    Null and empty texts, and texts without words, have an empty set and are linked with nothing;
    rows that repeat a doc_id are linked by their texts alone; a null doc_id is never a component's smallest
    (a component of such rows only has a null id); an empty table gives an empty result; columns other than
    doc_id and text are not read.
    """
    rows, of_node = linked(docs, words, link)
    least = of_node.groupBy("comp").agg(F.min("rep.doc_id").alias("component_id"))
    ids = of_node.join(least, "comp").select("node", "component_id")
    out = rows.select("doc_id", "n", "node").join(ids, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id"))
                      .otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, words: int = WORDS, link: int = LINK) -> DataFrame:
    """One row of ``docs`` per component of texts: that of smallest doc_id, null last, and then of the least text hash.

    Repeats of a row (doc_id and text) are reduced to one.  Texts without words are linked with nothing: their rows stay,
    one per doc_id and all of those without a doc_id.
    """
    rows, of_node = linked(docs, words, link)
    key = [F.coalesce(F.col("doc_id"), F.lit(0)).alias("k_doc"), F.col("doc_id").isNull().alias("k_null"), F.col("text_id").alias("k_text")]
    first = of_node.groupBy("comp").agg(F.min("rep").alias("rep")).select("rep.doc_id", "rep.text_id")
    bare = rows.filter("n = 0 and doc_id is not null").groupBy("doc_id").agg(F.min("text_id").alias("text_id"))
    found = first.unionByName(bare).select(*key)
    every = docs.select(F.struct(*docs.columns).alias("__doc"), F.col("doc_id").cast("bigint").alias("doc_id"), text_id().alias("text_id"),
                        (F.col("doc_id").isNull() & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")).alias("k_bare"))
    names = ["k_doc", "k_null", "k_text"]
    kept = every.filter("not k_bare").select("__doc", *key).join(found, names, "left_semi").dropDuplicates(names)  # dealt alike
    kept = kept.select("__doc").unionByName(every.filter("k_bare").select("__doc"))
    return kept.select(*[F.col("__doc").getField(c).alias(c) for c in docs.columns])


def op7_heavy_light_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return join_documents(documents(spark, sf_dir))


ORACLE_OP7 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))) END AS g FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
p AS (SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {LINK} * (a.n + b.n - count(*))),
l AS (SELECT u, v FROM p UNION ALL SELECT v, u FROM p),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT l.v, r.c FROM r JOIN l ON l.u = r.doc_id)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, c AS component_id
FROM s JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m ON m.doc_id = s.doc_id
"""

QUERIES = {"op7_heavy_light_join": op7_heavy_light_join}
ORACLE = {"op7_heavy_light_join": ORACLE_OP7}

import random
import re

import numpy as np
import pytest

from flowcube.llm import jaccard_join as J
from flowcube.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 4 else frozenset(tuple(w[i:i + 4]) for i in range(len(w) - 3))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    same = {}
    for i, (doc, _) in enumerate(rows):  # rows of one doc_id are one document
        if doc is not None and sets[i]:
            parent[root(i)] = root(same.setdefault(doc, i))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b:
                both = len(a & b)
                if 100 * both >= 85 * (len(a) + len(b) - both):
                    parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if sets[i] and doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(((doc, len(s), least.get(root(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=str)


def test_matches_brute_force(docs, rows):
    got = J.join_documents(docs).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute([(r[0], r[1]) for r in rows])


@pytest.mark.parametrize("x", [0, 9, 20])
def test_every_boundary_gives_the_same_components(spark, x, monkeypatch):
    import random
    rng = random.Random(x)
    rows = []
    for g in range(25):  # groups of light and heavy sets with one to three changed words at the ends
        base = [f"g{g}w{i}" for i in range(rng.randint(5, 45))]
        for _ in range(6):
            w = base[rng.randint(0, 2):len(base) - rng.randint(0, 2)]
            rows.append((len(rows), " ".join(w + [f"t{rng.randint(0, 2)}"] * rng.randint(0, 2))))
    common = [f"c{i}" for i in range(12)]
    for _ in range(40):  # a passage that many documents share
        rows.append((len(rows), " ".join(common + [f"u{rng.random()}" for _ in range(rng.randint(2, 30))])))
    monkeypatch.setattr(J, "boundary", lambda sizes, sketch: x)
    got = J.join_documents(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_star_of_near_copies_is_one_component(spark):
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 30):  # each copy links to the original, copies hardly to one another
        w = list(base)
        w[4 * i] = f"x{i}"
        w[(4 * i + 50) % 120] = f"y{i}"
        rows.append((i, " ".join(w)))
    got = J.join_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_need_and_prefix():
    for a in range(1, 60):
        for b in range(a, 60):
            o = J.need(a, b)
            assert 100 * o >= 85 * (a + b - o) and 100 * (o - 1) < 85 * (a + b - o + 1)


def test_keep_one(docs, rows):
    kept = J.keep_one(docs)
    want = {c for _, n, c in brute([(r[0], r[1]) for r in rows])}
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, want))


def test_empty(empty):
    assert J.join_documents(empty).count() == 0 and J.keep_one(empty).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200)]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}}


def test_keep_one_goes_by_texts_without_or_with_repeated_ids(spark):
    text = lambda g, i=None: " ".join(f"g{g}w{j}" if j != i else "other" for j in range(120))
    rows = [(None, text(1)), (None, text(2)), (None, text(3)), (None, text(3)),  # three different texts and a copy
            (None, text(4)), (None, text(4, 60)), (None, text(4, 30)),  # near copies, none with an id
            (9, text(5)), (None, text(5, 50)),  # a near copy of a row with an id
            (7, text(6)), (7, text(7)), (7, text(7)), (8, text(7, 40)),  # an id with two texts
            (None, ""), (None, " \n"), (10, None), (10, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    got = sorted(((r["doc_id"], (r["text"] or "").split(" ")[0]) for r in J.keep_one(df).collect()), key=str)
    want = [(None, f"g{g}w0") for g in (1, 2, 3, 4)] + [(9, "g5w0"), (7, "g6w0"), (7, "g7w0"), (10, ""), (None, ""), (None, "")]
    assert sorted(((d, t.strip()) for d, t in got), key=str) == sorted(want, key=str)
    ids = sorted((r["component_id"] for r in J.join_documents(df).filter("doc_id is null and n_shingles > 0").collect()), key=str)
    assert ids == [9] + [None] * 7


def test_fine_sketches_bound_the_difference_of_any_two_sizes():
    rng = np.random.default_rng(3)
    for a, b, common in [(600, 600, 500), (1000, 1100, 900), (4000, 4200, 100), (4090, 4100, 4080), (513, 4000, 500)]:
        pool = rng.integers(0, 2**63, a + b - common, dtype=np.int64).astype(np.uint64)
        x, y = np.unique(pool[:a]), np.unique(pool[a - common:])
        apart = len(np.setxor1d(x, y))
        got = J.fine_distance(J.fine_bits(x), J.fine_bits(y))
        assert got == J.fine_distance(J.fine_bits(y), J.fine_bits(x)) and got <= apart and got % 2 == apart % 2
        assert got > apart / 7
    assert J.fine_bits(pool[:64 * J.PARITY]) is None


def _compared(spark, monkeypatch, texts):
    """Component of every text, and the numbers of pairs in the two rounds."""
    pairs, verified = [], J.verified

    def counted(some, *args):
        some = some.localCheckpoint()
        pairs.append(some.count())
        return verified(some, *args)

    monkeypatch.setattr(J, "verified", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    return {r["doc_id"]: r["component_id"] for r in J.join_documents(df).collect()}, pairs


def test_a_large_group_of_near_copies_is_not_compared_in_pairs(spark, monkeypatch):
    rng = random.Random(8)
    base, texts = [f"w{rng.randrange(10**6)}" for _ in range(150)], []
    for i in range(400):
        words = list(base)
        for k in range(rng.randint(0, 4)):
            words[rng.randrange(150)] = f"own{i}x{k}"
        texts.append(" ".join(words))
    got, pairs = _compared(spark, monkeypatch, texts)
    sets = [{tuple(t.split()[j:j + 4]) for j in range(147)} for t in texts]
    whole = list(range(400))

    def root(i):
        while whole[i] != i:
            i = whole[i]
        return i

    for i in range(400):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                whole[b] = a
    assert got == {i: root(i) for i in range(400)}
    assert pairs[1] <= 400


def test_large_sets_with_a_common_passage_are_told_apart_by_their_sketches(spark):
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(10**7)}"
    passage = [word() for _ in range(900)]
    texts = [" ".join([*passage, *[word() for _ in range(1400)]]) for _ in range(6)]
    changed = texts[0].split()
    changed[1000] = "changed"
    df = spark.createDataFrame(list(enumerate([*texts, " ".join(changed), "a small set"])), "doc_id bigint, text string")
    classes = J.materialize(J.profiles(df).filter("block is null"))
    node = {r["doc_id"]: r["node"] for r in classes.collect()}
    every = spark.createDataFrame([(node[i], node[j]) for i in node for j in node if i < j], "u bigint, v bigint")
    kept = {(r["u"], r["v"]) for r in J.near(every, classes).collect()}
    assert kept == {(node[0], node[6])} | {(node[i], node[7]) for i in range(7)}  # small sets have the first sketch only

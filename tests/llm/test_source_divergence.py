import random
import re
from collections import Counter, defaultdict

import pytest

from flowcube.llm import source_divergence as D

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, top=200):
    count, found, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in ((r[1] or "", r[2] or "", r[3] or "") for r in rows):
        groups.add((lang, source))
        words = [w.translate(LOWER) for w in TERM.findall(text)]
        count[lang, source].update(words)
        found[lang].update(set(words))
    out = []
    for lang, source in groups:
        kept = [t for t, n in found[lang].items() if n >= 3]
        peers = [s for lg, s in groups if lg == lang]

        def p(counts):
            size = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (size + len(kept)) for t in kept}

        mine, whole = p(count[lang, source]), p(sum((count[lang, s] for s in peers), Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        pairs = []
        for other in peers:
            if other != source:
                q = p(count[lang, other])
                pairs.append((-sum(f(mine[t], q[t]) for t in kept), other.encode(), other))
        terms = [(-f(mine[t], whole[t]), t.encode(), t) for t in kept if count[lang, source][t] and mine[t] > whole[t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, item, -v, i + 1) for i, (v, _, item) in enumerate(items)]
    return Counter(out)


def got(df):
    return Counter(tuple(r) for r in df.collect())


def made(seed):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "ABcdéßž" for b in ("x", "Y", "zz", "ö", "中", "\U0001F600")] + ["it's", "A-b", "x9y", "_u_"]
    rows = []
    for i in range(150):
        lang = rng.choice(["en", "en", "de", None, "none"])
        source = None if rng.random() < 0.05 else f"s{rng.choice([0, 0, 0, 1, 2, 3])}" + ("é" if lang == "de" else "")
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) if lang != "none" else rng.choice(["1 2 3", None, ""])
        rows.append((i, text, lang, source))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_dense_definition(spark, seed):
    rows = made(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(4)
    assert got(D.audit(docs)) == brute(rows)


def test_shared_corpus(spark, docs, rows):
    assert got(D.audit(docs)) == brute(rows)


def test_ties_are_cut_in_utf8_order(spark, monkeypatch):
    """Many terms with equal counts: one merged cell longer than the report."""
    monkeypatch.setattr(D, "PIECE_BYTES", 50)
    rng = random.Random(4)
    names = ["t" + "".join(rng.choice("abcéž中") for _ in range(6)) for _ in range(500)]
    rows = [(i, " ".join(names), "en", "a") for i in range(3)] + [(9, "other " * 5, "en", "b")] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    out = got(D.audit(docs))
    assert out == brute(rows)
    assert sum(n for r, n in out.items() if r[1:3] == ("a", "term")) == 200


def test_terms_and_their_rows():
    import pyarrow as pa
    texts = ["", "Ab", "cD e", "", " x", "y ", "éÉ9ß", "...", "A"]
    for cut in (0, 3):
        words, row = D.terms(pa.array(texts, pa.binary()).slice(cut))
        assert [(w.decode(), i + cut) for w, i in zip(words.to_pylist(), row)] == [
            (w.translate(LOWER), i) for i, t in enumerate(texts) if i >= cut for w in TERM.findall(t)]


def test_large_counts_stay_exact(spark):
    big = 3_000_000_000_000
    df = spark.createDataFrame([(big, 5 * big, 7)], "c bigint, t bigint, v bigint")
    row = df.select(D.share(df.c, df.t, df.v).alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 1) // (5 * big + 7)


def test_empty_table(empty):
    assert D.audit(empty).collect() == []

import random
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from flowcube.llm import periodic_runs as P


def brute(word, least=24, times=3):
    """All runs by the definition: maximal stretches of every period, kept if no smaller period fits."""
    n, out = len(word), []
    for q in range(1, n // times + 1):
        i = q
        while i < n:
            if word[i] != word[i - q]:
                i += 1
                continue
            j = i
            while j < n and word[j] == word[j - q]:
                j += 1
            start, length = i - q, j - (i - q)
            if length >= max(least, times * q) and not any(
                    all(word[k] == word[k - p] for k in range(start + p, j)) for p in range(1, q)):
                out.append((start, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def made_words():
    rng = random.Random(3)
    a, b = "a", "ab"
    for _ in range(9):
        a, b = b, b + a
    yield list(b)  # a Fibonacci word
    yield ["a"] * 200
    yield list("ab" * 50 + "c" + "ab" * 40 + "abc" * 30)
    for _ in range(60):
        word = []
        while len(word) < 150:
            root = [rng.choice("abcd") for _ in range(rng.randint(1, 20))]
            word += (root * rng.randint(1, 12))[:rng.randint(1, 120)]
        yield word
    for _ in range(30):
        yield [rng.choice("ab") for _ in range(rng.randint(0, 160))]


@pytest.mark.parametrize("least, times", [(24, 3), (2, 2), (6, 2)])
def test_runs_equal_the_definition(monkeypatch, least, times):
    monkeypatch.setattr(P, "MIN_WORDS", least)
    monkeypatch.setattr(P, "MIN_TIMES", times)
    for word in made_words():
        ids = {c: i for i, c in enumerate(sorted(set(word)))}
        assert P.runs_of([ids[c] for c in word]) == brute(word, least, times)


def test_screen_loses_no_run():
    rng = random.Random(9)
    texts = [[c.encode() for c in w] for w in made_words()]
    for _ in range(30):  # runs amid words that occur once
        word = []
        for _ in range(4):
            word += [f"u{rng.random()}" for _ in range(rng.randint(0, 40))]
            root = [f"r{rng.randint(0, 9)}" for _ in range(rng.randint(1, 30))]
            word += (root * 9)[:rng.randint(20, 200)]
        texts.append([w.encode() for w in word])
    for words, parts in zip(texts, P.stretches(texts)):
        assert P.document_runs(words, parts) == brute(words)


def test_long_periodic_text_is_near_linear():
    import time
    t0 = time.time()
    assert P.runs_of([i % 7 for i in range(100_000)]) == [(0, 100_000, 7)]
    assert P.runs_of([0] * 100_000) == [(0, 100_000, 1)]
    assert time.time() - t0 < 30


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words) if n < 2000 else P.runs_of([{w: i for i, w in enumerate(sorted(set(words)))}[w] for w in words])
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return (doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            sha256(b" ".join(w for i, w in enumerate(words) if i not in drop)).hexdigest())


def test_query_equals_brute_force(spark, rows, tmp_path):
    rng = random.Random(1)
    extra = [(1000 + i, " \n".join(rng.choice(["ab", "b\x0bc", "é"]) for _ in range(rng.randint(0, 300)))) for i in range(60)]
    short = [(r[0], r[1]) for r in rows if len(r[1] or "") < 30_000] + extra
    spark.createDataFrame(short, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = P.op12(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = Counter(tuple(r) for r in out.collect())
    assert got == Counter(expected(*r) for r in short)
    assert sum(1 for r in got if r[1]) >= 15


def test_columns_pass_and_clash(spark, docs, empty, rows):
    out = P.with_runs(docs)
    assert out.columns == [*docs.columns, "periodic"] and out.count() == len(rows)
    again = P.with_runs(out.withColumn("periodic", F.lit(1)))
    assert again.columns == out.columns and again.select("periodic.n_words").count() == len(rows)
    assert P.with_runs(empty).collect() == []
    null = P.with_runs(docs.filter("text is null or text = ''")).select("periodic").distinct().collect()
    assert [r.periodic.asDict(True) for r in null] == [{"n_words": 0, "runs": [], "collapsed": ""}]

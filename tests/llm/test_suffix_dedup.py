import hashlib
import random

from flowcube.llm import suffix_dedup as S


def brute(rows):
    """Expected rows by a table of all 50-byte strings."""
    last = 2**63 - 1
    first = {}
    coded = [(last if i is None else i, i, (t or "").encode()) for i, t in rows]
    for order, _, b in coded:
        for p in range(len(b) - 49):
            w = b[p:p + 50]
            first[w] = min(first.get(w, order), order)
    out = []
    for order, i, b in coded:
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < order:
                gone[p:p + 50] = b"\x01" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_matches_brute_force(spark, docs, rows):
    got = S.remove_repeats(docs, bucket_bytes=20_000)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([(r[0], r[1]) for r in rows])


def test_small_alphabet_and_shifted_passages(spark):
    rng = random.Random(2)
    rows = []
    passage = "".join(rng.choice("ab") for _ in range(130))
    for i in range(60):
        cut, end = rng.randint(0, 60), rng.randint(70, 130)
        rows.append((i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 80))) + passage[cut:end]
                     + "".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))))
    rows += [(60, "z" * 49), (61, "z" * 49), (62, "y" * 200), (63, "y" * 51), (64, "y" * 50), (2, passage), (2, passage), (65, "é" * 60), (66, "xé" + "é" * 40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = S.remove_repeats(df, bucket_bytes=1_500)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_empty(empty):
    assert S.remove_repeats(empty).count() == 0


def test_loser_tree_orders_and_reports_prefixes():
    rng = random.Random(4)
    for _ in range(200):
        runs = []
        for _ in range(rng.randint(1, 7)):
            strings = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))).encode() for _ in range(rng.randint(0, 12))})
            shared, rest, tails = S.front_code(strings)
            assert S.unfront(shared, rest, tails) == strings
            runs.append((strings, shared))
        merged = list(S.merge_runs(runs))
        out = [runs[r][0][i] for r, i, _ in merged]
        assert out == sorted(s for strings, _ in runs for s in strings)
        for (_, _, pre), a, b in zip(merged[1:], out, out[1:]):
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            assert pre == n


def test_long_text_in_pieces(spark, monkeypatch):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    raw = text.encode()
    whole = list(S.packs([raw]))
    monkeypatch.setattr(S, "PIECE", 500)
    parts = list(S.packs([raw]))
    at = [a for _, _, m, seg in whole for n, off, b, e in seg for a in (m[b:e] - b + off).tolist()]
    cut = [a for _, _, m, seg in parts for n, off, b, e in seg for a in (m[b:e] - b + off).tolist()]
    assert len(parts) > 3 and at == cut


def test_texts_are_dealt_to_buckets_once(docs):
    got = S.remove_repeats(docs, bucket_bytes=20_000)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
    # the search for repeats and the cut read one exchange of texts; the other two by bucket hold anchors and ranges
    assert sum("- Exchange hashpartitioning(bucket#" in line for line in plan) == 3
    assert sum("ReusedExchange" in line and "Exchange hashpartitioning(bucket#" in line for line in plan) == 1

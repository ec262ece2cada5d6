import random
import zlib

from flowcube.llm import toxicity as X
from flowcube.sources.tables import table


def brute_segments(scores):
    """Maximal scoring segments by their recursive definition: the best segment, then both sides."""
    found = []

    def split(lo, hi):
        best = None
        for b in range(lo, hi):
            total = 0.0
            for e in range(b, hi):
                total += scores[e]
                key = (round(total, 9), -(e - b), -b)
                if total > 0 and (best is None or key > best[0]):
                    best = (key, b, e + 1, total)
        if best:
            _, b, e, total = best
            split(lo, b)
            found.append((b, e, total))
            split(e, hi)

    split(0, len(scores))
    return found


def test_segments_match_their_definition():
    rng = random.Random(6)
    for _ in range(300):
        weights = {f"t{i}": rng.uniform(0.3, 4) for i in range(4)}
        drift = -rng.uniform(0.1, 1.5)
        words = [rng.choice([*weights, "u", "u", "u"]) for _ in range(rng.randint(0, 25))]
        got = [(b, e) for b, e, _ in X.segments(words, weights, drift)]
        want = [(b, e) for b, e, _ in brute_segments([weights.get(w, drift) for w in words])]
        assert got == want, (words, weights, drift)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = X.op8_toxic_segments(spark, sf)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    known = [(rows[r["doc_id"]]["score"], r["toxic"]) for r in table(spark, sf, "labels").collect()
             if rows[r["doc_id"]]["held_out"]]
    pos, neg = [s for s, y in known if y], [s for s, y in known if not y]
    auc = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))
    hit = sum(s >= 0.7 for s in pos)
    wrong = sum(s >= 0.7 for s in neg)
    print("auc", auc, "recall", hit / len(pos), "false positives", wrong / len(neg))
    assert auc > 0.9 and hit / len(pos) > 0.8 and wrong / len(neg) < 0.05


def test_edge_cases(spark, docs, rows, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(5, None), (None, 1)], "doc_id bigint, toxic int")
    model = X.learn(docs.select("doc_id", "text"), labels)
    assert X.score(docs, model, ["doc_id", "kind"]).count() == len(rows)
    none = X.learn(empty, labels)
    assert X.score(empty, none, ["doc_id"]).count() == 0
    assert 0 <= X.score_text("", none)[0] <= 1 and 0 <= X.score_text(None, model)[0] <= 1

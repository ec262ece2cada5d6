import re

from flowcube.llm import line_quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, min_docs=Q.MIN_DOCS, max_share=Q.MAX_SHARE):
    """(base measures, base_failed, kept, cleaned text) per row."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    norm = lambda line: " ".join(WORD.findall(line)).translate(low)
    holders, first, texts = {}, {}, {}
    for i, t, host in rows:
        t = t or ""
        texts.setdefault(host, set()).add(t)
        for line in t.split("\n"):
            key = (host, norm(line))
            if key[1]:
                holders.setdefault(key, set()).add(t)
                if i is not None:
                    first[key] = min(first.get(key, i), i)
    out = []
    for i, t, host in rows:
        t = t or ""
        words = WORD.findall(t)
        grams = [tuple(words[j:j + 3]) for j in range(len(words) - 2)]
        many = {g for g in grams if grams.count(g) > 1} if len(grams) < 3000 else {
            g for g, c in __import__("collections").Counter(grams).items() if c > 1}
        hit = {j + k for j, g in enumerate(grams) if g in many for k in range(3)}
        lines = t.split("\n")
        dup = sum(1 for j, x in enumerate(lines) if WORD.search(x) and x in lines[:j])
        left = []
        for line in lines:
            key = (host, norm(line))
            n = len(holders.get(key, ()))
            gone = key[1] and n >= min_docs and n * 100 > len(texts[host]) * max_share and not (first.get(key) == i)
            if not gone:
                left.append(line)
        kept_words = sum(len(WORD.findall(x)) for x in left)
        failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
        verdict = not failed and kept_words * 100 >= len(words) * Q.MIN_LEFT
        out.append(((i, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), failed, verdict),
                    "\n".join(left)))
    return out


def test_matches_brute_force(docs, rows):
    got = Q.judge(docs, ["doc_id"]).select("doc_id", *Q.BASE, "base_failed", "kept").collect()
    want = [x[0] for x in brute([(r[0], r[1], r[3]) for r in rows])]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert any(not w[-1] for w in want) and any(w[-1] for w in want)


def test_clean_removes_lines_and_keeps_columns(docs, rows):
    got = Q.clean(docs)
    assert got.columns == docs.columns
    want = [(r[0], text, r[5]) for r, (v, text) in zip(rows, brute([(r[0], r[1], r[3]) for r in rows])) if v[-1]]
    seen = got.collect()
    assert sorted((str(r["doc_id"]), r["text"], r["kind"]) for r in seen) == sorted((str(a), b, c) for a, b, c in want)
    assert all(r["n_chars"] == len(r["text"]) for r in seen)
    # the shared line stays in the first document that holds it
    assert sum("\n" in r["text"] and r["text"].count("\n") == 2 for r in seen if r["doc_id"] is not None and 60 <= r["doc_id"] < 100) == 1


def test_near_copies_survive_once(spark):
    body = [f"line {i} " + " ".join(f"w{i}x{j}" for j in range(12)) for i in range(8)]
    rows = [(i, "\n".join(body + [f"own words {i}"]), "h") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert [r["doc_id"] for r in Q.clean(df).collect()] == [0]


def test_empty(empty):
    assert Q.judge(empty, ["doc_id"]).count() == 0 and Q.clean(empty).count() == 0


def test_pipeline_judges_a_shared_line_alike_in_hosts_of_any_size(spark):
    import corpus_pipeline

    rows = []
    for host, n in (("large", 600), ("small", 60)):  # the line stands in 25 documents: 4 % and 42 %
        for i in range(n):
            own = " ".join(f"{host}{i}w{j}" for j in range(60))
            rows.append((len(rows), own + ("\nall rights reserved" if i < 25 else ""), host))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    got = corpus_pipeline.quality(spark, df, "").collect()
    assert len(got) == len(rows)
    holders = {h: [r["doc_id"] for r in got if r["source"] == h and "reserved" in r["text"]] for h in ("large", "small")}
    assert holders == {"large": [0], "small": [600]}

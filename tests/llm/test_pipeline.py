import base64

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_one_after_the_other_match_brute_force(spark, docs, rows):
    import public_tokenizers as P
    import tiktoken

    from flowcube.llm import bpe
    from tests.llm.test_jaccard import brute as jaccard
    from tests.llm.test_quality import brute as quality

    with open(P.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    now = docs
    kept = [(r[0], text) for r, (v, text) in zip(rows, quality([(r[0], r[1], r[3]) for r in rows])) if v[-1]]
    smallest = {c for _, _, c in jaccard(kept)}
    want = {i: t for i, t in kept if i in smallest}
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, "")
        if name != "tokens":
            assert out.columns == docs.columns, name
        path = corpus_pipeline.materialize(out)
        steps[name] = path
        now = path
    assert {r["doc_id"] for r in steps["one_of_each"].collect()} == set(want)
    masked = {r["doc_id"]: r["text"] for r in steps["secrets"].collect()}
    assert set(masked) == set(want)
    assert sorted(map(str, steps["mix"].collect())) == sorted(map(str, steps["secrets"].collect()))
    final = {r["doc_id"]: r for r in steps["tokens"].collect()}
    assert set(final) == set(want)
    for i, r in final.items():
        assert r["ids"] == enc.encode_ordinary(masked[i] or "") and r["n_tokens"] == len(r["ids"]) and r["round_trip"]


def test_every_stage_takes_an_empty_table(spark, empty):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, corpus_pipeline.materialize(empty), "").count() == 0, name


def test_one_of_each_matches_five_words_and_eighty_percent(spark):
    import random

    from tests.llm.test_jaccard import brute as four_words

    rng = random.Random(8)
    rows = []
    for g in range(12):
        base = [f"g{g}w{rng.randint(0, 10**6)}" for _ in range(480)]
        cut = base[: round(480 * rng.uniform(0.78, 0.86))]
        spread = list(base)
        for i in range(10 + g % 3):
            spread[20 + 40 * i] = f"new{g}x{i}"
        rows += [(10 * g, " ".join(base)), (10 * g + 1, " ".join(cut)), (10 * g + 2, " ".join(spread)),
                 (10 * g + 3, " ".join(base[:12])), (10 * g + 4, " ".join(base[:13]))]
    sets = []
    for _, t in rows:
        w = t.split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)})
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    want = {rows[root(i)][0] for i in range(len(rows))}
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert {r["doc_id"] for r in corpus_pipeline.one_of_each(spark, df, "").collect()} == want
    assert want < {c for _, _, c in four_words(rows)}  # op7's contract leaves more of them


def test_result_carries_the_place_in_the_mix(spark):
    import random
    from collections import Counter, defaultdict

    from flowcube.llm import mixing

    rng = random.Random(4)
    rows = []
    for i in range(300):  # blocks of a few documents; two rows without and two with the same doc_id
        text = " ".join(f"w{rng.randint(0, 99)}" for _ in range(8_000))
        rows.append((None if i in (7, 8) else 5 if i == 6 else i, text, "en", "big" if i % 5 else "small" if i % 10 else None, 0))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    size = {t: len(t) for _, t, *_ in rows}
    mixed = corpus_pipeline.materialize(corpus_pipeline.mix(spark, df, ""))
    got = corpus_pipeline.materialize(corpus_pipeline.tokens(spark, mixed, ""))
    order = sorted(got.collect(), key=lambda r: r["place"])
    assert [r["place"] for r in order] == list(range(1, len(rows) + 1))
    # the places are those that mixing gives, row by row
    want = mixing.mix(df, order=corpus_pipeline.within_source(corpus_pipeline.text_digest())).collect()
    want.sort(key=lambda r: (r["mix_slot"], r["mix_seq"]))
    assert [(r["doc_id"], r["source"]) for r in order] == [(r["doc_id"], r["source"]) for r in want]
    # and they come from the table that the stage before wrote: another order of the same rows gives other places
    other = corpus_pipeline.materialize(df.orderBy("text"))
    back = corpus_pipeline.materialize(corpus_pipeline.tokens(spark, other, "")).orderBy("place").collect()
    by_text = sorted(rows, key=lambda r: r[1])
    assert [(r["doc_id"], r["source"]) for r in back] == [(r[0], r[3]) for r in by_text] != [(r["doc_id"], r["source"]) for r in order]
    order = want
    # no source is a block or more away from its target before the first source runs out
    total = defaultdict(int)
    for _, t, _, s, _ in rows:
        total[s] += size[t]
    raw = {s: b ** mixing.TEMPERATURE for s, b in total.items()}
    n = {s: max(1, int(w * mixing.PERIOD / sum(raw.values()) + 0.5)) for s, w in raw.items()}
    source_at = {r["mix_slot"]: r["source"] for r in order}
    blocks = {s: len({r["mix_slot"] for r in order if r["source"] == s}) for s in n}
    done = Counter()
    for t in range(max(source_at)):
        if t in source_at:
            done[source_at[t]] += 1
        if any(done[s] == blocks[s] for s in n):
            break
        assert all(abs((t + 1) * n[s] / sum(n.values()) - done[s]) < 1 for s in n), t
    assert sum(done.values()) > 5

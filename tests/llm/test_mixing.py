from collections import defaultdict

from flowcube.llm import mixing as M


def check_lag(rows, weights, q):
    """After any number of slots within the exact part every source is less than a block off its share."""
    slots = {s: k for k, s in rows}
    done = defaultdict(int)
    horizon = max(slots, default=-1)
    for t in range(horizon + 1):
        if t in slots:
            done[slots[t]] += 1
        for k, n in weights.items():
            assert abs((t + 1) * n / q - done[k]) < 1, (t, k)


def test_schedule_meets_every_window(spark):
    for ns in ([1], [1, 1, 1], [3, 5, 2], [7, 1, 1, 4, 13], [50, 1, 1, 1], [333, 211, 100, 56]):
        q = sum(ns)
        w = spark.createDataFrame([(str(i), n, i, q) for i, n in enumerate(ns)], "key string, n bigint, idx int, q bigint")
        got = M.schedule(w).collect()
        assert sorted(r["at"] for r in got) == list(range(q))
        for r in got:  # release and deadline of block nth + 1
            n = ns[r["idx"]]
            assert r["nth"] * q // n <= r["at"] < -(-(r["nth"] + 1) * q // n)
        check_lag([(r["idx"], r["at"]) for r in got], dict(enumerate(ns)), q)


def test_mix_keeps_rows_and_deviation(spark, docs, rows, empty):
    out = M.mix(docs, block_bytes=500, period=50)
    assert out.columns == docs.columns + ["mix_block", "mix_slot", "mix_seq", "mix_exact"]
    got = out.collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    assert len({(r["source"], r["mix_seq"]) for r in got}) == len(rows)
    by_slot = defaultdict(set)
    for r in got:
        by_slot[r["mix_slot"]].add(r["source"])
    assert all(len(v) == 1 for v in by_slot.values())  # a slot belongs to one source
    assert M.mix(empty).count() == 0
    assert M.interleave(docs).columns == docs.columns and M.interleave(docs).count() == len(rows)


def test_target_weights_hold_in_the_exact_part(spark):
    rows = [(i, "x" * 100, "big" if i % 10 else "small") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = M.mix(df, weights={"big": 3, "small": 1}, block_bytes=1000, period=4).filter("mix_exact").collect()
    blocks = {(r["source"], r["mix_block"]): r["mix_slot"] for r in got}
    check_lag([(k[0], s) for k, s in blocks.items()], {"big": 3, "small": 1}, 4)
    assert abs(sum(r["source"] == "big" for r in got) / len(got) - 0.75) < 0.02


def test_null_source_and_same_order_every_time(spark, docs):
    one = M.mix(docs, block_bytes=500).select("doc_id", "source", "mix_slot", "text").collect()
    two = M.mix(docs.repartition(3), block_bytes=500).select("doc_id", "source", "mix_slot", "text").collect()
    assert sorted(map(str, one)) == sorted(map(str, two))
    assert any(r["source"] is None for r in one)


def test_bytes_stay_within_a_block_and_the_longest_document(spark):
    """Documents of up to twelve blocks: whole documents are at most a block behind, or a block and the longest of them ahead."""
    import random
    rng = random.Random(3)
    rows = [(i, "x" * rng.choice([50, 400, 1500, 12_000 if i % 9 == 0 else 900]), rng.choice(["big", "big", "big", "mid", "small"])) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    weights, block, q = {"big": 3, "mid": 2, "small": 1}, 1000, 6
    got = M.mix(df, weights=weights, block_bytes=block, period=q).collect()
    assert len(got) == len(rows)
    last = max(r["mix_slot"] for r in got if r["mix_exact"])
    longest = max(len(t) for _, t, _ in rows)
    by_slot = defaultdict(lambda: defaultdict(int))
    for r in got:
        by_slot[r["mix_slot"]][r["source"]] += len(r["text"])
    done = defaultdict(int)
    for slot in range(last + 1):
        for source, n in by_slot[slot].items():
            done[source] += n
        for source, n in weights.items():
            ahead = done[source] - (slot + 1) * n / q * block
            assert -block < ahead < block + longest, (slot, source, ahead)
    assert last > 200

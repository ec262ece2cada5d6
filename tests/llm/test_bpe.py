import base64
import random

import public_tokenizers as P
import pytest
import tiktoken

from flowcube.llm import bpe


@pytest.fixture(scope="module")
def reference():
    with open(P.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(8)
    out = ["", None, "Hello world's  best\n\n  x", "<|endoftext|>", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "=" * 200, " " * 77 + "x", "\t\t\n \r\n",
           "straße naïve Ελλάδα привет 你好 \U0001F600\U0001F468‍\U0001F469 é", "\x1c\x1d\x85  x　y", "ab" * 300,
           "0123456789" * 30, "don't we'll I'm they'd you've he's 'S 'T", "\x00\x01\x7f", "ſſK", "٣٤٥ ²³½ Ⅷ"]
    alphabet = "abcdeths ionrT.,'\n 0123éß中=-_/"
    out += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(400)]
    out += ["".join(rng.choice("abcde") for _ in range(3000)), " ".join("".join(rng.choice("etaoinsr") for _ in range(rng.randint(1, 14))) for _ in range(4000))]
    return out


def test_encodes_as_the_library_and_decodes_back(spark, reference):
    rows = [(i, t, "k") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kind string").repartition(4)
    path = P.path(bpe.VOCABULARY)
    out = bpe.encode(df, path, ["doc_id", "kind"], chunk_chars=5_000)
    assert out.columns == ["doc_id", "kind", "ids"]
    assert all(bpe.read_ranks(path)[i] for i in range(256))
    back = out.select("doc_id", "ids", bpe.decode(out["ids"], path).alias("raw")).collect()
    assert len(back) == len(rows)
    for r in back:
        text = rows[r["doc_id"]][1] or ""
        assert r["ids"] == reference.encode_ordinary(text), repr(text[:60])
        assert bytes(r["raw"]) == text.encode()


def test_many_languages_vocabulary(spark):
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    other = tiktoken.Encoding("m", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = " ".join(t for t in texts() if t)[:20_000]
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert bpe.encode(df, P.path("byte_bpe_multi_50k.tiktoken"), ["doc_id"]).first()["ids"] == other.encode_ordinary(text)


def test_ties_take_the_leftmost_pair(spark, reference):
    """Short pieces with many equal and overlapping pairs, up to and beyond the bytes of the one-pair-a-step fold."""
    rng = random.Random(3)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 56))) for letters in ("an", "eé", "aeo", "ßs", "tion", "=-") for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(words)), "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: r["ids"] for r in bpe.encode(df, P.path(bpe.VOCABULARY), ["doc_id"]).collect()}
    assert got == {i: reference.encode_ordinary(w) for i, w in enumerate(words)}


def test_rank_map_finds_every_pair_and_no_other():
    pairs = {(a, b): (a * 31 + b) % 60_000 for a in range(0, 3000, 7) for b in range(a % 5, 200, 9)}
    shift, cells = bpe.placed([a for a, _ in pairs], [b for _, b in pairs], list(pairs.values()))

    def rank(a, b):
        at = (a * bpe.MIX[2] + b * bpe.MIX[3] + shift[(a * bpe.MIX[0] + b * bpe.MIX[1]) % bpe.BUCKETS]) % bpe.PLACES
        return cells[at] % bpe.NONE if cells[at] >> 20 == a * bpe.VOCABULARY_MAX + b else None

    assert all(rank(a, b) == pairs.get((a, b)) for a in range(0, 3000, 5) for b in range(210))


def test_long_pieces_and_short_ones_take_the_same_merges(reference):
    import numpy as np

    rng, ranks = random.Random(5), bpe.rank_map(P.path(bpe.VOCABULARY))
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 400))) for letters in ("a", "an", "eé", "=-", "etaoinsr", "你好") for _ in range(20)]
    one = lambda w: ranks.bytes[np.frombuffer(w.encode(), np.uint8)]
    ids, sizes = bpe.merge_short(np.concatenate([one(w) for w in words]), np.array([len(w.encode()) for w in words]), ranks)
    got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert got == [bpe.merge_long(one(w), ranks) for w in words]
    ids, sizes = bpe.merge_words(words, ranks)
    assert got == [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    whole = [w for w in words if reference._pat_str and w.isalpha()]
    assert [got[words.index(w)] for w in whole] == [reference.encode_ordinary(w) for w in whole]


def test_a_store_of_pieces_that_is_full_starts_anew(spark, reference, monkeypatch):
    monkeypatch.setattr(bpe, "PIECES_MAX", 3)
    rows = [(i, f"one two{i % 3} three four five" + " x" * i) for i in range(40)] + [(40, None), (41, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = {r["doc_id"]: r["ids"] for r in bpe.encode(df, P.path(bpe.VOCABULARY), ["doc_id"], chunk_chars=50).collect()}
    assert got == {i: reference.encode_ordinary(t or "") for i, t in rows}


def test_plans_hold_no_table_of_the_vocabulary(spark):
    path = P.path(bpe.VOCABULARY)
    out = bpe.encode(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), path, ["doc_id"])
    out = out.select("doc_id", bpe.packed(out["ids"]).alias("packed"), bpe.decode(out["ids"], path).alias("raw"))
    assert len(out._jdf.queryExecution().toString()) < 20_000
    assert bytes(out.first()["raw"]) == b"a b"


def test_decoding_skips_nulls_and_unknown_ids(spark):
    df = spark.createDataFrame([(1, [97, None, 60_000, -1, 98]), (2, None), (3, [])], "k int, ids array<int>").coalesce(1)
    got = {r["k"]: r["raw"] for r in df.select("k", bpe.decode(df["ids"], P.path(bpe.VOCABULARY)).alias("raw")).collect()}
    tokens = bpe.read_ranks(P.path(bpe.VOCABULARY))
    assert bytes(got[1]) == tokens[97] + tokens[98] and got[2] is None and bytes(got[3]) == b""


def test_empty(empty):
    assert bpe.encode(empty, P.path(bpe.VOCABULARY), ["doc_id"]).count() == 0

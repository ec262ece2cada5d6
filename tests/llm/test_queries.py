"""The registered queries of op5, op6 and op9 as they are, against recomputation from the table they read."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

from flowcube.llm import bpe, mixing, sharding
from tests.conftest import SF_SMALL


def table(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()


def test_op6_digests_equal_the_library(spark):
    import public_tokenizers as P
    import tiktoken
    with open(P.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for r in table(spark):
        ids = enc.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(),
                          hashlib.sha256((r.text or "").encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op6_bpe_fold(spark, SF_SMALL).collect()}
    assert got == want


def test_op5_places_every_document_by_its_bytes(spark):
    got = mixing.op5_pfair_mix(spark, SF_SMALL).collect()
    rows = table(spark)
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((r.doc_id, r.source, len((r.text or "").encode())) for r in rows)
    by_source = defaultdict(list)
    for r in got:
        by_source[r.source].append(r)
    slot_of = {}
    for source, held in by_source.items():
        held.sort(key=lambda r: hashlib.md5(str(r.doc_id).encode()).hexdigest())
        before = 0
        for seq, r in enumerate(held):
            assert (r.seq, r.block) == (seq, before // mixing.BLOCK_BYTES)
            before += r.size
            assert slot_of.setdefault(r.slot, (source, r.block)) == (source, r.block)  # a slot is one block of one source
        assert [r.slot for r in held] == sorted(r.slot for r in held)
    # exact up to the first slot at which a source has run out
    total = {s: sum(r.size for r in held) for s, held in by_source.items()}
    raw = {s: max(1, b) ** mixing.TEMPERATURE for s, b in total.items()}
    n = {s: max(1, int(w * mixing.PERIOD / sum(raw.values()) + 0.5)) for s, w in raw.items()}
    q = sum(n.values())
    for slot, (source, block) in slot_of.items():  # release and deadline of the block
        assert block * q // n[source] <= slot < -(-(block + 1) * q // n[source])


def test_op9_sizes_digests_and_slots(spark):
    got = sharding.op9_label_shards(spark, SF_SMALL).collect()
    rows = table(spark)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows)
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    shards = defaultdict(list)
    for r in got:
        shards[r.shard].append(r.slot)
    assert set(shards) == set(range(8)) and max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cadence.llm import byte_bpe as B
from cadence.llm import complement_pack as K
from cadence.llm import queries
from tests.llm.helpers import SF, awkward, documents, empty, rows, with_clashes

MULTI = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")
PIECES = ["a", "é", "ß", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "'s", "'", "12", "!?", "中文", "\U0001F600", "<|endoftext|>"]


def plain(path):
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=B.read_ranks(path), special_tokens={})


def test_every_document_round_trips(spark):
    enc = plain(MULTI)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op8_byte_bpe(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = np.array(enc.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_awkward_rows(spark):
    docs = awkward(spark)
    coded = B.encode_documents(with_clashes(docs), MULTI, P.PATTERN)
    raw = B.decode_documents(coded, MULTI, P.PATTERN)
    key = lambda t: (t[0] is not None, t[0] or 0, t[1])
    assert sorted(((r.doc_id, bytes(r.raw)) for r in raw.collect()), key=key) == \
        sorted(((r.doc_id, (r.text or "").encode()) for r in docs.collect()), key=key)
    assert B.round_trip(empty(spark), MULTI, P.PATTERN).count() == 0


def test_safe_cuts_change_no_id(monkeypatch):
    rng = random.Random(3)
    enc = plain(MULTI)
    monkeypatch.setattr(B, "LONG_CHARS", 5)
    cuts = 0
    for _ in range(400):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(40)))
        parts = B.safe_parts(text, 5)
        assert "".join(parts) == text
        assert [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)
        assert B.encode(enc, text).tolist() == enc.encode_ordinary(text)
        cuts += len(parts) - 1
    assert cuts > 200


def test_vocabulary_file_and_rank_file_agree_with_the_tokenizers_library():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    enc = B.encoding(JSON, P.PATTERN)
    assert B.read_ranks(JSON) == B.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(30)))
        assert B.encode(enc, text).tolist() == t.encode(text, add_special_tokens=False).ids


def check_packing(found, texts, ids_of, capacity):
    by_doc, by_seq = defaultdict(dict), defaultdict(list)
    for r in found:
        assert r.piece not in by_doc[r.doc_id]
        by_doc[r.doc_id][r.piece] = r
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for d, text in texts.items():
        ids, at = [*ids_of(text), 0], 0
        for n in range(len(by_doc[d])):
            r = by_doc[d][n]
            assert (r.start, r.length == capacity or n == 0) == (at, True) and 0 < r.length <= capacity
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq)


def test_packing_of_the_given_documents(spark):
    t = Tokenizer.from_file(JSON)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.op4_packing(spark, SF).collect()
    n = check_packing(found, texts, lambda x: t.encode(x, add_special_tokens=False).ids, 2048)
    total = sum(r.length for r in found)
    assert n <= 1.03 * -(-total // 2048) + 1


def test_packing_awkward_rows_and_sequences(spark):
    docs = awkward(spark).where("doc_id <> 6 or doc_id is null")
    enc = plain(JSON)
    packed = K.pack_documents(with_clashes(docs), JSON, P.PATTERN, 16, keep_ids=True)
    found = packed.where("doc_id is not null").collect()
    texts = {r.doc_id: r.text or "" for r in docs.where("doc_id is not null").collect()}
    all_rows = packed.collect()
    assert sum(r.length for r in all_rows if r.doc_id is None) == len(enc.encode_ordinary("lone text")) + 2
    seqs = {r.sequence_id: r.ids for r in K.sequences(packed).collect()}
    whole = {d: [*enc.encode_ordinary(t), 0] for d, t in texts.items()}
    for r in found:
        ids = whole[r.doc_id][r.start:r.start + r.length]
        assert seqs[r.sequence_id][r.offset:r.offset + r.length] == ids
    assert K.pack_documents(empty(spark), JSON, P.PATTERN).count() == 0


def test_one_hot_length_is_spread(spark):
    docs = documents(spark, ["same text"] * 500 + ["other words here"] * 3)
    n = len(plain(JSON).encode_ordinary("same text")) + 1
    found = K.pack_documents(docs, JSON, P.PATTERN, 4 * n).collect()
    places = {(r.sequence_id, r.offset) for r in found}
    assert len(places) == len(found) == 503
    assert len({r.sequence_id for r in found}) <= 127


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 64, 2048])
    counts = Counter(rng.randint(1, capacity) for _ in range(rng.choice([1, 50, 4000])))
    patterns = K.plan(counts, capacity)
    held = Counter()
    for lengths, n in patterns:
        assert n > 0 and sum(lengths) <= capacity
        for x in lengths:
            held[x] += n
    assert held == counts
    bins = sum(n for _, n in patterns)
    least = -(-sum(x * n for x, n in counts.items()) // capacity)
    big = sum(n for x, n in counts.items() if 2 * x > capacity)
    assert max(least, big) <= bins <= 1.25 * max(least, big) + 1


def test_exact_complements_come_first():
    left = Counter({60: 2, 40: 1, 30: 2, 10: 5})
    assert K.exact_patterns(left, 100) == [((60, 40), 1), ((60, 30, 10), 1)]
    assert +left == Counter({30: 1, 10: 4})
    assert K.plan({}, 10) == []


def test_pieces_cut_from_the_end():
    assert K.piece_bounds(5, 2) == [(0, 1), (1, 2), (3, 2)]
    assert K.piece_bounds(4, 2) == [(0, 2), (2, 2)]
    assert K.piece_bounds(1, 2) == [(0, 1)]

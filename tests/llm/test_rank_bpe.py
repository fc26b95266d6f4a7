import hashlib
import json
import random

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from cadence.llm import queries
from cadence.llm import rank_bpe as R
from tests.llm.helpers import SF, awkward, empty, with_clashes

JSON = P.path("byte_bpe_50k.json")
PIECES = ["a", "é", "ß", " ", "  ", "\n", "\t", "\x1c", "\x1f", "\x85", "\xa0", " ", "​", "　", "'s", "'ll",
          "'", "12", "²", "Ⅷ", "!?", "中文", "\U0001F600", "<|endoftext|>", "<|end", "the", "\x00", "é", "x" * 150]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def enc():
    return R.RankEncoder(JSON, P.PATTERN)


def test_every_document_as_the_library_encodes_and_decodes_it(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op13_rank_bpe(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_random_texts_as_the_library(enc, library):
    rng = random.Random(5)
    for _ in range(1500):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(30)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert enc.encode(text) == ids
        assert enc.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_any_ids_decode_as_in_the_library(enc, library):
    rng = random.Random(6)
    for _ in range(300):
        ids = [rng.randrange(50257) if rng.random() < 0.3 else rng.randrange(256) for _ in range(rng.randrange(12))]
        assert enc.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_texts_are_cut_where_no_id_changes(enc, library, monkeypatch):
    monkeypatch.setattr("cadence.llm.byte_bpe.LONG_CHARS", 7)
    rng = random.Random(7)
    for _ in range(300):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(40)))
        assert enc.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_both_searches_make_the_same_parts(enc):
    rng = random.Random(8)
    words = [bytes(rng.choice(b"etaoinshr'") for _ in range(rng.randrange(1, 300))) for _ in range(200)]
    words += [b"a" * n for n in (1, 2, 3, 4, 5, 127, 500)] + [b"ab" * 200, "é".encode() * 90, bytes(range(256))]
    for word in words:
        assert enc._short(word) == enc._long(word)


def test_one_endless_word(enc, library):
    text = "ab" * 100_000
    assert enc.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_the_narrow_pattern_splits_as_the_given_one():
    import regex

    narrow, given = R.narrow_pattern(P.PATTERN), regex.compile(P.PATTERN)
    rng = random.Random(9)
    chars = list(map(chr, range(R.NARROW)))
    for _ in range(2000):
        text = "".join(rng.choice(chars if rng.random() < 0.5 else "a 'sl1! \n") for _ in range(20))
        assert narrow.findall(text) == given.findall(text)
    assert R.narrow_pattern(r"\w+") is None and R.narrow_pattern(r"[[a]&&[b]]") is None


def test_words_beyond_what_is_kept(enc, monkeypatch):
    monkeypatch.setattr(R, "KEPT_WORDS", 4)
    kept = R._Kept(lambda w: (len(w),))
    for w in ["a", "bb", "a", "ccc", "dddd", "a", "e" * 99, "bb"]:
        assert kept[w] == (len(w),)
    assert len(kept) <= 2 and len(kept.before) <= 2 and "e" * 99 not in kept


def test_awkward_rows(spark):
    docs = awkward(spark)
    coded = R.encode_documents(with_clashes(docs), JSON, P.PATTERN)
    texts = R.decode_documents(coded, JSON, P.PATTERN)
    key = lambda t: (t[0] is not None, t[0] or 0, t[1])
    assert sorted(((r.doc_id, r.text) for r in texts.collect()), key=key) == \
        sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=key)
    none = [r for r in R.round_trip(with_clashes(docs), JSON, P.PATTERN).collect() if r.doc_id in (2, 3)]
    nothing = hashlib.sha256(b"").hexdigest()
    assert [(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in none] == [(0, nothing, nothing)] * 2
    assert R.round_trip(empty(spark), JSON, P.PATTERN).count() == 0


def test_unknown_settings_are_refused(tmp_path):
    spec = json.load(open(JSON, encoding="utf-8"))
    spec["model"]["ignore_merges"] = True
    path = tmp_path / "v.json"
    path.write_text(json.dumps(spec))
    with pytest.raises(R.UnsupportedVocabulary, match="ignore_merges"):
        R.RankEncoder(str(path), P.PATTERN)

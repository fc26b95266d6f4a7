import random

import public_tokenizers as P
from tokenizers import Tokenizer

from cadence.llm import byte_bpe as B
from cadence.llm import complement_pack as K
from tests.llm.helpers import documents
from tests.llm.test_tokens import JSON, PIECES, check_packing


def test_added_tokens_are_read_as_by_the_tokenizers_library(spark):
    t = Tokenizer.from_file(JSON)
    ids_of = lambda text: t.encode(text, add_special_tokens=False).ids
    enc = B.encoding(JSON, P.PATTERN)
    assert ids_of("<|endoftext|>") == [50256]
    rng = random.Random(6)
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext|", "  <|endoftext|>  \n", "", "plain"]
    texts += ["".join(rng.choice(PIECES) for _ in range(rng.randrange(40))) for _ in range(300)]
    for text in texts:
        assert B.encode_with_added(enc, JSON, text).tolist() == ids_of(text)
    found = K.pack_documents(documents(spark, texts), JSON, P.PATTERN, 16).collect()
    check_packing(found, dict(enumerate(texts)), ids_of, 16)


def test_a_rank_file_has_no_added_tokens():
    assert B.added_tokens(P.path("byte_bpe_50k.tiktoken")) == (None, {})

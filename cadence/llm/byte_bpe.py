"""Byte-level BPE encoding and decoding (operator 8).

The tiktoken library does the merging, from a local rank file whose path is
a parameter.  Every match of the split pattern is encoded separately and no
special tokens are known, so their strings in a text are ordinary text;
``encode_with_added`` reads a vocabulary file's added tokens as their ids.

Long texts are first cut at safe boundaries: before a blank or line end that
follows something else than white space.  No match of the pattern reaches
over such a place (only white space runs and a leading blank belong to a
match, and both begin there), so the cut changes no id.  A stretch without
such a place stays in one piece.  Decoding joins the tokens' raw bytes, so a token that ends
inside a character does no harm.

Null texts count as empty: no tokens, and the digests of nothing.  Equal
texts and equal ids each give their own row; other columns are left behind.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cadence.llm.text import as_bytes, bound_batches, only

LONG_CHARS = 1 << 16
# A blank or line end after anything that no definition of white space covers.
SAFE_CUT = re.compile(r"(?<=\S)(?=[ \n])")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level BPE vocabulary files:
    bytes that print stand for themselves, the others for code points from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, from a rank file or a byte-level BPE vocabulary (.json).

    In the vocabulary file ids follow the order of merges, so an id serves as
    the rank; its added (special) tokens are left out.
    """
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", [])}
        alphabet = byte_alphabet()
        return {bytes(alphabet[c] for c in token): i
                for token, i in spec["model"]["vocab"].items() if token not in special}
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    """One encoder per Python worker and file."""
    import tiktoken

    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=read_ranks(path),
                             special_tokens={})


def safe_parts(text: str, size: int | None = None) -> list[str]:
    """Cut a text at safe boundaries into parts of ``size`` characters (LONG_CHARS) or slightly more."""
    size = size or LONG_CHARS
    if len(text) <= size:
        return [text]
    parts, start = [], 0
    while len(text) - start > size:
        cut = SAFE_CUT.search(text, start + size)
        if cut is None:
            break
        parts.append(text[start:cut.start()])
        start = cut.start()
    parts.append(text[start:])
    return parts


def encode(enc, text: str) -> np.ndarray:
    """The ids of a whole text."""
    if len(text) <= LONG_CHARS:
        return np.array(enc.encode_ordinary(text), "<u4")
    return np.concatenate([np.array(enc.encode_ordinary(p), "<u4") for p in safe_parts(text)])


@lru_cache(maxsize=4)
def added_tokens(path: str) -> tuple[re.Pattern | None, dict[str, int]]:
    """A pattern of a vocabulary file's added tokens (the longest first), and their ids."""
    if not path.endswith(".json"):
        return None, {}
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f).get("added_tokens", [])
    if any(t.get(flag) for t in tokens for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path}: added tokens that take blanks or whole words only")
    ids = {t["content"]: t["id"] for t in tokens}
    longest_first = sorted(ids, key=len, reverse=True)
    return re.compile("|".join(map(re.escape, longest_first))) if ids else None, ids


def encode_with_added(enc, path: str, text: str) -> np.ndarray:
    """The ids of a whole text, in which an added token of the vocabulary file is one id."""
    found, ids = added_tokens(path)
    if found is None or not found.search(text):
        return encode(enc, text)
    parts, start = [], 0
    for m in found.finditer(text):
        parts += [encode(enc, text[start:m.start()]), np.array([ids[m.group()]], "<u4")]
        start = m.end()
    return np.concatenate([*parts, encode(enc, text[start:])])


def decode(enc, ids) -> bytes:
    """The raw bytes of a sequence of ids."""
    return enc.decode_bytes([int(i) for i in ids])


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of every text, as an array of longs."""
    bound_batches(docs.sparkSession)

    def run(batches):
        enc = encoding(path, pattern)
        for batch in batches:
            ids = [encode(enc, t.decode()).astype(np.int64) for t in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int64()))], [id_col, "ids"])

    rows = only(docs, id_col, text_col)
    id_type = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, ids array<bigint>")


def decode_documents(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id, raw): the bytes behind every row's ids."""
    def run(batches):
        enc = encoding(path, pattern)
        for batch in batches:
            raw = [decode(enc, ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())],
                                             [id_col, "raw"])

    rows = only(encoded, id_col, "ids")
    id_type = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, raw binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode every text, decode its ids, and return digests of both."""
    bound_batches(docs.sparkSession)

    def run(batches):
        enc = encoding(path, pattern)
        for batch in batches:
            counts, ids_sha, decoded_sha = [], [], []
            for raw in as_bytes(batch.column(1)):
                ids = encode(enc, raw.decode())
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                decoded_sha.append(hashlib.sha256(enc.decode_bytes(ids.tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(decoded_sha, pa.string())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = only(docs, id_col, text_col)
    id_type = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, n_tokens bigint, ids_sha256 string, "
                                "decoded_sha256 string")

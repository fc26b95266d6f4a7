"""BPE encoding and decoding by contiguous rank arrays (operator 13).

Encodes as a byte-level BPE vocabulary file (.json) prescribes, whose path is a
parameter.  A text is split at the file's added tokens, which are one id each,
and the rest by the split pattern into words.  The bytes of a short word are its
first parts.  Two contiguous arrays hold the parts between boundaries and the
merge rank of each part with the next one; the smallest rank is searched again
and again (the leftmost of equal ones), the boundary it stands for is deleted,
and the ranks of the two neighbours are looked up anew.  A rank belongs to a
pair of parts, as the file lists it, not to the bytes that they form.

That search is quadratic, which is fastest for short words; words of more than
``SHORT_BYTES`` bytes go through a heap of ranks in the same order.  A worker
remembers the ids of ``KEPT_WORDS`` short words at most.

The split pattern is a parameter; long texts are cut between something else and
white space, so it must be one of which no match reaches over such a place, as is
so for the byte-level pre-tokenizer's own.

Decoding joins the raw bytes of the tokens and reads them as UTF-8; bytes that
are not UTF-8 become U+FFFD.  No special tokens are added and none are skipped.

Null texts count as empty: no ids, and the digests of nothing.  Equal texts and
equal or null ids each give their own row; other columns are left behind.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cadence.llm.byte_bpe import byte_alphabet, safe_parts
from cadence.llm.text import as_bytes, bound_batches, only

SHORT_BYTES = 128
KEPT_WORDS = 800_000
KEPT_CHARS = 40
NO_RANK = 1 << 62
GONE = -1
ID_BITS = 32
# Settings of a vocabulary file under which its ids are what this module computes.
MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
         "byte_fallback": False, "ignore_merges": False}
SPLITTER = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


class UnsupportedVocabulary(ValueError):
    """A vocabulary file with settings that this encoder does not know."""


def _check(spec: dict, path: str) -> None:
    wrong = [f"model.{k}" for k, v in MODEL.items() if (spec["model"].get(k) or None) != (v or None)]
    wrong += [f"pre_tokenizer.{k}" for k, v in SPLITTER.items() if (spec.get("pre_tokenizer") or {}).get(k) != v]
    wrong += ["normalizer"] if spec.get("normalizer") else []
    wrong += ["added_tokens"] if any(t.get(flag) for t in spec.get("added_tokens", [])
                                     for flag in ("single_word", "lstrip", "rstrip")) else []
    if wrong:
        raise UnsupportedVocabulary(f"{path}: {', '.join(wrong)}")


# Most texts hold no character from here on; for these the standard library's
# regular expressions split as the given pattern does, in half the time.
NARROW = 0x250
WIDE = re.compile(f"[^\\x00-{chr(NARROW - 1)}]")


def _members(class_name: str) -> str:
    """The characters below ``NARROW`` of a class, for a bracket expression."""
    inside = [c for c in map(chr, range(NARROW)) if regex.match(class_name, c)]
    return "".join(re.escape(c) for c in inside)


def narrow_pattern(pattern: str) -> re.Pattern | None:
    """The pattern for texts of characters below ``NARROW`` only, if it can be written."""
    out, in_brackets = [], False
    for item in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.S):
        if item.startswith("\\p{") or item == "\\s":
            members = _members(item)
            item = members if in_brackets else f"[{members}]"
        elif item == "\\S" and not in_brackets:
            item = f"[^{_members(chr(92) + 's')}]"
        elif item[0] == "\\" and item[1:].isalnum():
            return None
        elif item in "[]":
            if item == "[" and in_brackets:
                return None
            in_brackets = item == "["
        out.append(item)
    return re.compile("".join(out))


class RankEncoder:
    """The merges, ids and added tokens of one vocabulary file."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        _check(spec, path)
        alphabet = byte_alphabet()
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        raw = {token: bytes(alphabet[c] for c in token)
               for token in spec["model"]["vocab"] if token not in added}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.id = {raw[token]: i for token, i in spec["model"]["vocab"].items() if token in raw}
        # A pair of parts is one number; ``merged`` tells which token its rank makes.
        self.rank = {self.id[raw[a]] << ID_BITS | self.id[raw[b]]: i for i, (a, b) in enumerate(merges)}
        self.merged = [self.id[raw[a] + raw[b]] for a, b in merges]
        self.byte_id = [self.id[bytes([b])] for b in range(256)]
        self.bytes_of = {i: token for token, i in self.id.items()}
        self.bytes_of.update({i: token.encode() for token, i in added.items()})
        self.added = added
        self.find_added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.pattern, self.narrow = regex.compile(pattern), narrow_pattern(pattern)
        self.words = _Kept(lambda word: tuple(self.word(word.encode())))

    # -- one word ----------------------------------------------------------
    def word(self, data: bytes) -> list[int]:
        """The ids of one word's bytes."""
        return self._short(data) if len(data) <= SHORT_BYTES else self._long(data)

    def _short(self, data: bytes) -> list[int]:
        # parts[i] is the token between two boundaries, ranks[i] what deleting
        # the boundary between parts i and i + 1 ranks.
        rank, merged = self.rank.get, self.merged
        parts = [self.byte_id[b] for b in data]
        ranks = [rank(a << ID_BITS | b, NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            i = ranks.index(least)
            part = parts[i] = merged[least]
            del parts[i + 1], ranks[i]
            # Part i has grown: refresh its rank with either neighbour.
            if i:
                ranks[i - 1] = rank(parts[i - 1] << ID_BITS | part, NO_RANK)
            if i < len(ranks):
                ranks[i] = rank(part << ID_BITS | parts[i + 1], NO_RANK)
        return parts

    def _long(self, data: bytes) -> list[int]:
        """The same parts by a heap of (rank, place), for long words."""
        n = len(data)
        parts = [self.byte_id[b] for b in data]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(a: int) -> None:
            if after[a] < n:
                left, right = parts[a], parts[after[a]]
                found = self.rank.get(left << ID_BITS | right)
                if found is not None:
                    heapq.heappush(heap, (found, a, left, right))

        for a in range(n):
            offer(a)
        while heap:
            found, a, left, right = heapq.heappop(heap)
            b = after[a]
            # Stale where a part has changed or gone since.
            if parts[a] != left or b >= n or parts[b] != right:
                continue
            parts[a], parts[b], after[a] = self.merged[found], GONE, after[b]
            if after[a] < n:
                before[after[a]] = a
            offer(a)
            if a:
                offer(before[a])
        return [p for p in parts if p != GONE]

    # -- whole texts -------------------------------------------------------
    def plain(self, text: str) -> list[int]:
        """The ids of a text in which no added token is looked for."""
        ids: list[int] = []
        for part in safe_parts(text):
            narrow = self.narrow is not None and not WIDE.search(part)
            words = (self.narrow if narrow else self.pattern).findall(part)
            ids.extend(chain.from_iterable(map(self.words.__getitem__, words)))
        return ids

    def encode(self, text: str) -> list[int]:
        if self.find_added is None or not self.find_added.search(text):
            return self.plain(text)
        ids, start = [], 0
        for m in self.find_added.finditer(text):
            ids += self.plain(text[start:m.start()])
            ids.append(self.added[m.group()])
            start = m.end()
        return ids + self.plain(text[start:])

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class _Kept(dict):
    """A bounded memory of what a function made of short strings.

    When it is full the older half goes: what is asked for again moves from the
    half that was filled before into the one that fills now.
    """

    def __init__(self, make):
        self.make, self.before = make, {}

    def __missing__(self, key: str) -> tuple[int, ...]:
        found = self.before.get(key)
        if found is None:
            found = self.make(key)
            if len(key) > KEPT_CHARS:
                return found
        if len(self) >= KEPT_WORDS // 2:
            self.before = dict(self)
            self.clear()
        self[key] = found
        return found


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> RankEncoder:
    """One encoder per Python worker and file."""
    return RankEncoder(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of every text, as an array of longs."""
    bound_batches(docs.sparkSession)

    def run(batches):
        enc = encoder(path, pattern)
        for batch in batches:
            ids = [enc.encode(t.decode()) for t in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int64()))],
                                             [id_col, "ids"])

    rows = only(docs, id_col, text_col)
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, ids array<bigint>")


def decode_documents(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id, text): the text behind every row's ids; null ids are none."""
    def run(batches):
        enc = encoder(path, pattern)
        for batch in batches:
            texts = [enc.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    rows = only(encoded, id_col, "ids")
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode every text, decode its ids, and return digests of both."""
    bound_batches(docs.sparkSession)

    def run(batches):
        enc = encoder(path, pattern)
        decimal = {i: str(i) for i in enc.bytes_of}
        for batch in batches:
            counts, ids_sha, decoded_sha = [], [], []
            for raw in as_bytes(batch.column(1)):
                ids = enc.encode(raw.decode())
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(enc.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(decoded_sha, pa.string())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = only(docs, id_col, text_col)
    id_type = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, n_tokens bigint, ids_sha256 string, "
                                "decoded_sha256 string")

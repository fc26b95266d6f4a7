"""Phrase collocations by prefix-free parsing (operator 12).

1. Parsing: texts are lower-cased (A-Z only) and split into pieces and words.  A run
   of ``OVERLAP`` words whose hash divides by ``PERIOD`` is a trigger.  A chunk goes
   from the beginning of a piece or trigger to the end of the next trigger or of the
   piece, so neighbouring chunks overlap in a trigger, and no chunk is a proper prefix
   of another that was cut at a trigger.  Equal passages fall into equal chunks,
   wherever they stand: the distinct chunks with their frequencies are the dictionary.
2. Words are counted in the same pass over the texts.  In the dictionary a chunk's
   words stand as often as the chunk occurs, but a trigger that the next chunk begins
   with counts there only.
3. Spans: pairs and triples of frequent words are summed in one pass, in proportion to
   the dictionary.  A pair is the keys of its two words.  All distinct words are known,
   so it is checked that no frequent word shares its key, and then the sums of the keys
   are the pairs' exact counts; otherwise pairs are counted like longer phrases.
   Triples are hashes, and serve as a filter of fixed size that never loses a frequent
   one.  A task sums its spans and writes them as arrays, a row for each of ``PARTS``
   parts of the hashes; the arrays of a part are summed where Spark brings them together.
4. Phrases: from each such word on, a window of up to ``LONGEST`` words goes as far as
   each three neighbours occur often enough together.  Equal runs of such words are
   summed before they are taken apart into windows.  Each window stands for all
   phrases that it begins with, once for all of them.  Windows are summed in the tasks
   and sorted by range; runs of equal beginnings in the sorted windows give the phrases'
   counts, of the texts and not of hashes.  A run inside a partition is whole, runs at
   its ends are summed over partitions.
5. Every cut of every candidate looks up its two parts by joins; the lowest score
   counts, and what stands in an equally frequent longer candidate goes.

A window has at most ``LONGEST`` words, which overlap by all but one, so the phrases of
a chunk lie inside it.  Counts are 64-bit numbers, scores are computed in decimals of
38 digits.  A null text is empty, a null lang is ``und`` and counts together with a
lang of that name.  Every row counts by itself, ids are not read, and other columns are
left behind.  Ties in rank are impossible: phrases of one lang differ.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.text import BUFFER_BYTES, SpanHashes, as_bytes, bound_batches, buffers, mix, only
from cadence.session import delete_path, materialise

LONGEST = 5
OVERLAP = LONGEST - 1
PERIOD = 16
LEAST = 100
TOP = 2000
UNKNOWN = "und"
HELD_ROWS = 300_000
HELD_TEXT_BYTES = 32 << 20
HELD_SPANS = 3_000_000
# Words are found in so many bytes at a time: their arrays stay in the cache.
RUN_BYTES = 1 << 17
# Spans are dealt by the first bits of their hashes.
PART_BITS = 12
PARTS = 1 << PART_BITS
# Filters: a bit for each hash, 8 MB whatever there is to hold.
FILTER_BITS = 26
BLOCK_BITS = 15
# Words are joined by a byte that sorts before all others; \x00 and \x01 inside words
# are written as two bytes each, so that equal beginnings stand together when sorted.
JOINT = b"\x00"
ESCAPES = ((b"\x01", b"\x01\x02"), (b"\x00", b"\x01\x01"))
_BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n\n ")
_WIDE_BLANKS = re.compile(rb"  +")
# For each number of bytes, the mask of as many first ones of a little-endian word.
_LOW_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


# -- parsing -----------------------------------------------------------------------

class Words:
    """The words of one buffer of texts joined by ``\\n``: places, pieces and hashes.

    In the buffer pieces end in ``\\n`` and words in a piece are one ``JOINT`` apart.
    """

    def __init__(self, raw: bytes):
        data = np.frombuffer(raw, np.uint8)
        gaps = np.flatnonzero((data == 10) | (data == JOINT[0]))
        after = np.concatenate([[0], gaps[:-1] + 1]) if len(gaps) else gaps
        found = gaps > after
        self.raw, self.starts, self.ends = raw, after[found], gaps[found]
        # Words of one piece have one number.
        ended = data[gaps] == 10
        self.piece = (np.cumsum(ended) - ended)[found]
        self.spans = SpanHashes(data)
        self.hashes = self.spans.spans(self.starts, self.ends)
        n = len(self.starts)
        last = np.flatnonzero(np.append(self.piece[1:] != self.piece[:-1], True)) if n else np.empty(0, np.int64)
        # For each word the place after its piece's last word.
        self.stop = np.repeat(last + 1, np.diff(np.concatenate([[0], last + 1])))

    def triggers(self, overlap: int, period: int) -> np.ndarray:
        """Whether a trigger begins at each word."""
        n = len(self.starts)
        found = np.zeros(n, bool)
        if n >= overlap:
            mixed = np.zeros(n - overlap + 1, np.uint64)
            for i in range(overlap):
                mixed = mix(mixed + self.hashes[i:n - overlap + 1 + i])
            found[:len(mixed)] = (mixed % np.uint64(period) == 0) & (self.piece[overlap - 1:] == self.piece[:len(mixed)])
        return found

    def text(self, first: int, stop: int) -> bytes:
        return self.raw[self.starts[first]:self.ends[stop - 1]]


def normalised(text: bytes) -> bytes:
    """A text with pieces ended by ``\\n`` and words one ``JOINT`` apart."""
    out = text.lower().translate(_BREAKS)
    for byte, written in ESCAPES:
        if byte in out:
            out = out.replace(byte, written)
    out = _WIDE_BLANKS.sub(b" ", out).replace(b" \n", b"\n").replace(b"\n ", b"\n")
    return out.strip(b" ").replace(b" ", JOINT)


def plain(phrase: bytes) -> str:
    """A phrase as text, its words one blank apart."""
    out = phrase.replace(JOINT, b" ")
    for byte, written in reversed(ESCAPES):
        out = out.replace(written, byte)
    return out.decode()


def chunk_spans(words: Words, overlap: int = OVERLAP, period: int = PERIOD) -> tuple[np.ndarray, np.ndarray]:
    """(first, stop): the chunks of a buffer, as ranges of words."""
    n = len(words.starts)
    opens = words.triggers(overlap, period)
    if n:
        opens[0] = True
        opens[1:] |= words.piece[1:] != words.piece[:-1]
    first = np.flatnonzero(opens)
    follows = np.append(first[1:], n)
    stop = words.stop[first] if n else first
    # A chunk that another one of the same piece follows ends with that one's trigger.
    return first, np.where(follows < stop, follows + overlap, stop)


def own_words(words: Words, overlap: int = OVERLAP, period: int = PERIOD) -> np.ndarray:
    """For a buffer of one chunk a piece: whether each word counts in its chunk.

    All do but those of a trigger that ends the chunk, which is not its beginning.
    """
    n = len(words.starts)
    at = np.arange(n)
    begins = np.concatenate([[True], words.piece[1:] != words.piece[:-1]]) if n else np.empty(0, bool)
    opens = np.maximum.accumulate(np.where(begins, at, 0)) if n else at
    closing = words.stop - overlap
    held = (closing > opens) & (closing >= 0)
    held &= words.triggers(overlap, period)[np.maximum(closing, 0)] if n else held
    return ~(held & (at >= closing))


def distinct(raw: bytes, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray,
             lang: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(order by keys, where in it another text begins) of spans by keys that are hashes; None where two
    texts, or texts of two langs, have one key."""
    order = np.argsort(keys)
    new = np.concatenate([[True], keys[order[1:]] != keys[order[:-1]]])[:len(keys)]
    # Texts of one key are compared with the one before, eight bytes at a time.
    again = np.flatnonzero(~new)
    one, other = order[again], order[again - 1]
    left = ends[one] - starts[one]
    if not np.array_equal(left, ends[other] - starts[other]) or not np.array_equal(lang[one], lang[other]):
        return None
    eights = np.ndarray(len(raw) + 1, "<u8", bytes(raw) + bytes(8), strides=(1,))
    x, y = starts[one], starts[other]
    while len(left):
        if np.any((eights[x] ^ eights[y]) & _LOW_BYTES[np.minimum(left, 8)]):
            return None
        more = left > 8
        x, y, left = x[more] + 8, y[more] + 8, left[more] - 8
    return order, np.flatnonzero(new)


def _cut(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The texts of the given spans of a buffer."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.Array.from_buffers(pa.binary(), len(starts), [
        None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.frombuffer(raw, np.uint8)[at])])


class Sums:
    """How often each text of a lang occurs, summed by texts as far as they are held."""

    def __init__(self, held_rows: int, keyed: bool):
        self.held_rows, self.keyed, self.held, self.rows, self.size = held_rows, keyed, [], 0, 0

    def add(self, raw: bytes, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray, lang: np.ndarray,
            n: np.ndarray) -> None:
        if not len(keys):
            return
        # Each text by itself where a hash stands for two.
        order, new = distinct(raw, starts, ends, keys, lang) or (np.arange(len(keys)), np.arange(len(keys)))
        first = order[new]
        texts = _cut(raw, starts[first], ends[first])
        self.held.append((texts, keys[first], lang[first], np.add.reduceat(n[order], new)))
        self.rows += len(first)
        self.size += len(texts.buffers()[2])

    def batches(self, langs: list[str], last: bool = False):
        """Batches of (lang, text, key, n), when there are many to write or it is the ``last`` call."""
        if not self.held or not (last or self.rows > self.held_rows or self.size > HELD_TEXT_BYTES):
            return
        texts = pa.concat_arrays([h[0] for h in self.held])
        keys, lang, n = (np.concatenate([h[i] for h in self.held]) for i in (1, 2, 3))
        self.held, self.rows, self.size = [], 0, 0
        places = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1).astype(np.int64)
        self.add(texts.buffers()[2].to_pybytes(), places[:-1], places[1:], keys, lang, n)
        if last or self.rows > self.held_rows // 2 or self.size > HELD_TEXT_BYTES // 2:
            texts, keys, lang, n = self.held.pop()
            self.rows = self.size = 0
            names = pa.array(langs, pa.string())
            key = keys.view(np.int64) if self.keyed else np.zeros(len(keys), np.int64)
            for i in range(0, len(texts), 50_000):
                of = slice(i, i + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(lang[of])), texts[of], pa.array(key[of]), pa.array(n[of])], COUNTED)


COUNTED = ["lang", "text", "key", "n"]


class Langs:
    """Numbers for the names of langs as they are met; ``hash`` is a hash of each."""

    def __init__(self):
        self.names: list[str] = []
        self.code: dict[str, int] = {}
        self.hash = np.empty(0, np.uint64)

    def codes(self, column: pa.Array) -> np.ndarray:
        coded = column.dictionary_encode()
        for name in coded.dictionary.to_pylist():
            if name not in self.code:
                self.code[name] = len(self.names)
                self.names.append(name)
                self.hash = np.append(self.hash, np.uint64(_lang_hash(name)))
        place = np.array([self.code[name] for name in coded.dictionary.to_pylist()], np.int64)
        return place[coded.indices.to_numpy()]


def parse_and_count(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", period: int = PERIOD,
                    held_rows: int = HELD_ROWS) -> DataFrame:
    """(lang, text, key, n): the distinct chunks and words with their frequencies.

    A word has its key.  A chunk's key is 0, and so is that of the empty word, which
    stands for all words of a lang.
    """
    bound_batches(docs.sparkSession)

    def run(batches):
        langs, totals = Langs(), Counter()
        chunks, counted = Sums(held_rows, keyed=False), Sums(held_rows, keyed=True)
        for batch in batches:
            texts = [normalised(t) for t in as_bytes(batch.column(1))]
            lang = langs.codes(batch.column(0))
            totals.update(dict.fromkeys(langs.names, 0))
            for first, last, data, starts, _ in buffers(texts, RUN_BYTES):
                words = Words(data.tobytes()[:-1].replace(b" ", b"\n") + b"\n")
                of = lang[np.searchsorted(starts, words.starts, side="right") - 1 + first]
                a, b = chunk_spans(words, period=period)
                begin, end = words.starts[a], words.ends[b - 1]
                chunks.add(words.raw, begin, end, mix(words.spans.spans(begin, end) + langs.hash[of[a]]), of[a],
                           np.ones(len(a), np.int64))
                counted.add(words.raw, words.starts, words.ends, word_keys(words, langs.hash[of]), of,
                            np.ones(len(of), np.int64))
                for g, n in enumerate(np.bincount(of, minlength=len(langs.names)).tolist()):
                    totals[langs.names[g]] += n
                yield from chunks.batches(langs.names)
                yield from counted.batches(langs.names)
        yield from chunks.batches(langs.names, last=True)
        yield from counted.batches(langs.names, last=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.string()), pa.array([b""] * len(totals), pa.binary()),
             pa.array([0] * len(totals), pa.int64()), pa.array(list(totals.values()), pa.int64())], COUNTED)

    rows = only(docs, lang_col, text_col).toDF("lang", "text")
    found = rows.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text").mapInArrow(
        run, "lang string, text binary, key bigint, n bigint")
    # Tasks have summed already; dealt by the same columns, Spark sums once more after the shuffle only.
    return found.repartition("lang", "text", "key").groupBy("lang", "text", "key").agg(F.sum("n").alias("n"))


def chunks_of(counted: DataFrame) -> DataFrame:
    """(lang, chunk, n): the dictionary of distinct chunks with their frequencies."""
    return counted.where((F.col("key") == 0) & (F.length("text") > 0)).select("lang", F.col("text").alias("chunk"), "n")


def words_of(counted: DataFrame) -> DataFrame:
    """(lang, word, n, key): the occurrences of every word; the empty word stands for all of a lang."""
    return counted.where((F.col("key") != 0) | (F.length("text") == 0)).select(
        "lang", F.col("text").alias("word"), "n", "key")


def parse(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", period: int = PERIOD,
          held_rows: int = HELD_ROWS) -> DataFrame:
    """(lang, chunk, n): the dictionary of distinct chunks with their frequencies."""
    return chunks_of(parse_and_count(docs, text_col, lang_col, period, held_rows))


def chunk_buffers(batches, langs: Langs):
    """(words, lang of each word, weight of each word) of runs of the dictionary's chunks, however small the batches are."""
    def taken(held: list):
        lang, weight = (np.concatenate([h[i] for h in held]) for i in (0, 2))
        # No chunk holds a line end, so it may stand after each: chunks are pieces.
        texts = pc.binary_join_element_wise(pa.concat_arrays([h[1] for h in held]), b"\n", b"")
        places = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
        raw = memoryview(texts.buffers()[2])
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(places, places[first] + RUN_BYTES, side="right")) - 1)
            words = Words(bytes(raw[places[first]:places[last]]))
            of = words.piece + first
            yield words, lang[of], weight[of]
            first = last

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append((langs.codes(batch.column(0)), batch.column(1), batch.column(2).to_numpy()))
            size += batch.column(1).nbytes
        if size >= BUFFER_BYTES:
            yield from taken(held)
            held, size = [], 0
    if held:
        yield from taken(held)


# -- phrases -----------------------------------------------------------------------

def _lang_hash(name: str) -> int:
    raw = np.frombuffer(name.encode() + b"\n", np.uint8)
    return int(SpanHashes(raw).spans(np.array([0]), np.array([len(raw)]))[0])


def word_keys(words: Words, lang_hash: np.ndarray) -> np.ndarray:
    """A hash of each word and its lang, never 0."""
    return mix(words.hashes + lang_hash) | np.uint64(1)


def joined_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of what has two hashes in this order."""
    return mix(first * np.uint64(3) + second)


def span_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of each pair (a, b), and of each triple (a, 0)."""
    return np.where(b == 0, a, joined_keys(a, b))


def _places(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _holds(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = _places(keys)
    return bits[place >> 3] >> (place & 7) & 1 == 1


def _filter(placed: DataFrame) -> np.ndarray:
    """A bit for each place, set for all given ones; the size is fixed."""
    low = F.lit((1 << BLOCK_BITS) - 1)
    blocks = placed.select(F.shiftright("place", BLOCK_BITS).alias("block"), F.col("place").bitwiseAND(low).alias("bit")) \
        .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    out = np.zeros((1 << FILTER_BITS - BLOCK_BITS, 1 << BLOCK_BITS - 3), np.uint8)
    for r in blocks:
        out[r.block] = np.frombuffer(r.bits, np.uint8)
    return out.reshape(-1)


def keys_clash(words: DataFrame, least: int) -> bool:
    """Whether a word that occurs ``least`` times shares its key with another one; ``words``: all (lang, word, n, key)."""
    shared = words.where(F.length("word") > 0).groupBy("key").agg(F.count("*").alias("words"), F.max("n").alias("n"))
    return not shared.where((F.col("words") > 1) & (F.col("n") >= least)).isEmpty()


def frequent_words(words: DataFrame) -> np.ndarray:
    """The filter of the given words (lang, word, key)."""
    return _filter(words.where(F.length("word") > 0).select(
        F.shiftrightunsigned("key", 64 - FILTER_BITS).alias("place")))


def _links(words: Words, keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each word and the one after it in its chunk are known."""
    inside = np.arange(len(keys)) + 1 < words.stop
    return inside & known & np.append(known[1:], False)


def dealt_spans(dictionary: DataFrame, known_words: np.ndarray, period: int = PERIOD) -> DataFrame:
    """(part, a, b, n): the pairs and triples of known words, summed in tasks, as arrays of each part of the hashes.

    A pair has the keys of its two words, a triple its hash and no ``b``.
    """
    shared = dictionary.sparkSession.sparkContext.broadcast(known_words)

    def packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
            None, pa.py_buffer((8 * bounds).astype(np.int32)), pa.py_buffer(values)])

    def dealt(held: list):
        for pairs in (True, False):
            a, b, n = (np.concatenate([h[i + (0 if pairs else 3)] for h in held]) for i in range(3))
            if len(a):
                hashes, a, b, n = summed_spans(a, b, n)
                parts = hashes >> np.uint64(64 - PART_BITS)
                begins = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]]))
                bounds = np.append(begins, len(a))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts[begins].astype(np.int32)), packed(a, bounds),
                     packed(b, bounds) if pairs else pa.nulls(len(begins), pa.binary()), packed(n, bounds)],
                    ["part", "a", "b", "n"])

    def run(batches):
        langs, held, size = Langs(), [], 0
        for words, lang, weight in chunk_buffers(batches, langs):
            keys = word_keys(words, langs.hash[lang])
            linked = _links(words, keys, _holds(shared.value, keys))
            begins = linked & own_words(words, period=period)
            two = np.flatnonzero(begins)
            three = np.flatnonzero(begins & np.append(linked[1:], False))
            triples = joined_keys(joined_keys(keys[three], keys[three + 1]), keys[three + 2])
            held.append((keys[two], keys[two + 1], weight[two],
                         triples, np.zeros(len(three), np.uint64), weight[three]))
            size += len(two) + len(three)
            if size > HELD_SPANS:
                yield from dealt(held)
                held, size = [], 0
        if held:
            yield from dealt(held)

    return dictionary.select("lang", "chunk", "n").mapInArrow(run, "part int, a binary, b binary, n binary")


def frequent_spans(dictionary: DataFrame, known_words: np.ndarray, least: int, period: int = PERIOD) -> DataFrame:
    """(a, b, n): the pairs and triples of known words that occur ``least`` times.

    A pair has the keys of its two words.  A triple has its hash and 0, and its count is
    that of all triples with this hash.
    """
    def run(batches):
        # Sums of whole parts, as many at once as are held.
        held, size, at = [], 0, None
        for batch in batches:
            for part, a, b, n in zip(*[c.to_pylist() for c in batch.columns]):
                if part != at and size > HELD_SPANS:
                    yield frequent(held)
                    held, size = [], 0
                at, size = part, size + len(n) // 8
                held.append((a, bytes(len(a)) if b is None else b, n))
        if held:
            yield frequent(held)

    def frequent(held: list) -> pa.RecordBatch:
        a, b, n = (np.frombuffer(b"".join(x), kind) for x, kind in zip(zip(*held), (np.uint64, np.uint64, np.int64)))
        _, a, b, n = summed_spans(a, b, n)
        many = n >= least
        return pa.RecordBatch.from_arrays(
            [pa.array(a[many].view(np.int64)), pa.array(b[many].view(np.int64)), pa.array(n[many])], ["a", "b", "n"])

    spans = dealt_spans(dictionary, known_words, period)
    return spans.repartition("part").sortWithinPartitions("part").mapInArrow(run, "a bigint, b bigint, n bigint")


def summed_spans(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, a, b, n): distinct spans with their sums, by their hashes."""
    hashes = span_hashes(a, b)
    for order in (np.argsort(hashes), None):
        # Spans that share a hash may stand mixed: only then all columns are sorted.
        order = np.lexsort((b, a, hashes)) if order is None else order
        h, x, y = hashes[order], a[order], b[order]
        other = h[1:] != h[:-1]
        new = other | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        if np.array_equal(other, new):
            break
    first = np.flatnonzero(np.concatenate([[True], new])[:len(a)])
    return h[first], x[first], y[first], np.add.reduceat(n[order], first) if len(n) else n


def spans_filter(spans: DataFrame) -> np.ndarray:
    """The filter of the given pairs and triples (a, b)."""
    def run(batches):
        for batch in batches:
            a, b = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(_places(span_hashes(a, b)))], ["place"])

    return _filter(spans.select("a", "b").mapInArrow(run, "place bigint"))


def pair_counts(spans: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, phrase, size, f): the pairs of the given words (lang, word, key), where no two share a key."""
    first = words.select("lang", F.col("word").alias("first"), F.col("key").alias("a"))
    second = words.select(F.col("word").alias("second"), F.col("key").alias("b"))
    return spans.where(F.col("b") != 0).join(first, "a").join(second, "b").select(
        "lang", F.concat("first", F.lit(JOINT), "second").alias("phrase"), F.lit(2).alias("size"), F.col("n").alias("f"))


def linked_runs(dictionary: DataFrame, known_words: np.ndarray, known_spans: np.ndarray, shortest: int = 3,
                longest: int = LONGEST, period: int = PERIOD, held_rows: int = HELD_ROWS) -> DataFrame:
    """(lang, run, starts, n): the runs of words of which each ``shortest`` (2 or 3) neighbours are known, in all chunks.

    The first ``starts`` words of a run begin windows; what follows them belongs to the
    next chunk, and is kept as far as their windows reach.
    """
    shared = dictionary.sparkSession.sparkContext.broadcast((known_words, known_spans))

    def rows(held: Counter):
        items = list(held.items())
        for i in range(0, len(items), 50_000):
            part = items[i:i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k, _ in part], pa.string()), pa.array([k[1] for k, _ in part], pa.binary()),
                 pa.array([k[2] for k, _ in part], pa.int32()), pa.array([n for _, n in part], pa.int64())],
                ["lang", "run", "starts", "n"])
        held.clear()

    def run(batches):
        held: Counter = Counter()
        langs = Langs()
        for words, lang, weight in chunk_buffers(batches, langs):
            names, raw = langs.names, words.raw
            keys = word_keys(words, langs.hash[lang])
            linked = _links(words, keys, _holds(shared.value[0], keys))
            pairs = joined_keys(keys[:-1], keys[1:])
            linked[:-1] &= _holds(shared.value[1], pairs)
            if shortest == 3:
                at = np.flatnonzero(linked & np.append(linked[1:], False))
                linked[:] = False
                linked[at] = _holds(shared.value[1], joined_keys(pairs[at], keys[at + 2]))
            begins = linked & own_words(words, period=period)
            # Words that begin windows, one after the other in one chunk, make a run.
            first = np.flatnonzero(begins & ~np.append(False, begins[:-1]))
            last = np.flatnonzero(begins & ~np.append(begins[1:], False))
            ended = np.flatnonzero(~linked)
            stop = np.minimum(ended[np.searchsorted(ended, last)] + shortest - 1, last + longest)
            for x, y, g, k, starts in zip(words.starts[first].tolist(), words.ends[stop - 1].tolist(),
                                          lang[first].tolist(), weight[first].tolist(), (last - first + 1).tolist()):
                held[names[g], raw[x:y], starts] += k
            if len(held) > held_rows:
                yield from rows(held)
        yield from rows(held)

    found = dictionary.select("lang", "chunk", "n").mapInArrow(run, "lang string, run binary, starts int, n bigint")
    return found.groupBy("lang", "run", "starts").agg(F.sum("n").alias("n"))


def _rows(held: Counter, names: list[str]):
    """Batches of (lang, bytes, n)."""
    items = list(held.items())
    for i in range(0, len(items), 50_000):
        part = items[i:i + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k, _ in part], pa.string()), pa.array([k[1] for k, _ in part], pa.binary()),
             pa.array([n for _, n in part], pa.int64())], names)
    held.clear()


def windows(runs: DataFrame, longest: int = LONGEST, held_rows: int = HELD_ROWS) -> DataFrame:
    """(lang, window, n): from each word on that begins windows, the linked words that follow."""
    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for lang, text, starts, n in zip(*[c.to_pylist() for c in batch.columns]):
                words = text.split(JOINT)
                for i in range(starts):
                    held[lang, JOINT.join(words[i:i + longest])] += n
            if len(held) > held_rows:
                yield from _rows(held, columns)
        yield from _rows(held, columns)

    columns = ["lang", "window", "n"]
    return runs.select("lang", "run", "starts", "n").mapInArrow(run, "lang string, window binary, n bigint")


def phrase_counts(found: DataFrame, least: int, longest: int = LONGEST, shortest: int = 2) -> DataFrame:
    """(lang, phrase, size, f): the phrases of ``shortest`` words or more that windows begin with ``least`` times."""
    def run(batches):
        # For each number of words: the run that goes on, its count, and whether it
        # holds the partition's first row.
        words_of, langs = [], None
        sums, whole = [0] * (longest + 1), [False] * (longest + 1)
        out: list[tuple] = []
        first = True

        def close(size: int, last: bool) -> None:
            if len(words_of) >= size and (sums[size] >= least or last or not whole[size]):
                out.append((langs, JOINT.join(words_of[:size]), size, sums[size]))

        for batch in batches:
            for lang, window, n in zip(*[c.to_pylist() for c in batch.columns]):
                parts = window.split(JOINT)
                same = 0
                if lang == langs:
                    while same < len(words_of) and same < len(parts) and words_of[same] == parts[same]:
                        same += 1
                for size in range(max(shortest, same + 1), len(words_of) + 1):
                    close(size, False)
                for size in range(shortest, len(parts) + 1):
                    if size <= same:
                        sums[size] += n
                    else:
                        sums[size], whole[size] = n, not first
                words_of, langs, first = parts, lang, False
            if len(out) > 50_000:
                yield _phrases(out)
        for size in range(shortest, len(words_of) + 1):
            close(size, True)
        yield _phrases(out)

    sorted_windows = found.repartitionByRange("lang", "window").sortWithinPartitions("lang", "window")
    partial = sorted_windows.select("lang", "window", "n").mapInArrow(
        run, "lang string, phrase binary, size int, f bigint")
    return partial.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def _phrases(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out)) or [(), (), (), ()]
    types = [pa.string(), pa.binary(), pa.int32(), pa.int64()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                       ["lang", "phrase", "size", "f"])
    out.clear()
    return batch


# -- scores ------------------------------------------------------------------------

def _cuts(candidates: DataFrame) -> DataFrame:
    """Each candidate at each of its cuts, with the two parts."""
    def run(batches):
        for batch in batches:
            at, cut, left, right = [], [], [], []
            for i, phrase in enumerate(batch.column(1).to_pylist()):
                words = phrase.split(JOINT)
                for k in range(1, len(words)):
                    at.append(i)
                    cut.append(k)
                    left.append(JOINT.join(words[:k]))
                    right.append(JOINT.join(words[k:]))
            kept = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(cut, pa.int32()), pa.array(left, pa.binary()), pa.array(right, pa.binary())],
                [*kept.schema.names, "k", "first_part", "rest_part"])

    return candidates.select("lang", "phrase", "size", "a").mapInArrow(
        run, "lang string, phrase binary, size int, a bigint, k int, first_part binary, rest_part binary")


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, n, score) of every candidate that stays.

    ``counts``: (lang, phrase, size, f) of all frequent phrases and words; ``totals``: (lang, n).
    """
    candidates = counts.where(F.col("size") > 1).withColumnRenamed("f", "a")
    lefts = counts.select("lang", F.col("phrase").alias("first_part"), F.col("f").alias("l"))
    rights = counts.select("lang", F.col("phrase").alias("rest_part"), F.col("f").alias("r"))
    cut, path = materialise(_cuts(candidates).join(lefts, ["lang", "first_part"]).join(rights, ["lang", "rest_part"]),
                            "collocation-cuts")
    # A part with all but one word stands in the candidate; it goes if it never stands elsewhere.
    covered = (cut.where((F.col("k") == F.col("size") - 1) & (F.col("a") >= F.col("l")))
               .select("lang", F.col("first_part").alias("phrase"))
               .unionByName(cut.where((F.col("k") == 1) & (F.col("a") >= F.col("r")))
                            .select("lang", F.col("rest_part").alias("phrase"))).distinct())
    exact = "cast({} as decimal(38, 0))".format
    score = F.expr(f"({exact(1000)} * {exact('a')} * {exact('n')}) div ({exact('l')} * {exact('r')})")
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("low")
    best = (cut.join(totals, "lang").withColumn("score", score)
            .groupBy("lang", "phrase", "size", "a", "n").agg(lowest))
    return best.join(covered, ["lang", "phrase"], "left_anti").select(
        "lang", "phrase", "size", "a", "low.l", "low.r", "n", "low.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, period: int = PERIOD,
                 held_rows: int = HELD_ROWS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's ``top`` phrases.

    ``period`` (the mean length of chunks in long pieces) and ``held_rows`` (what a
    task sums before it writes) change the work, not the result.
    """
    spark = docs.sparkSession
    counted, counted_path = materialise(parse_and_count(docs, period=period, held_rows=held_rows), "collocation-chunks")
    dictionary, every = chunks_of(counted), words_of(counted)
    words, words_path = materialise(every.where(F.col("n") >= least), "collocation-words")
    known = frequent_words(words)
    spans, spans_path = materialise(frequent_spans(dictionary, known, least, period), "collocation-spans")
    # Where words share a key, pairs are windows too.
    shortest = 2 if keys_clash(every, least) else 3
    runs = linked_runs(dictionary, known, spans_filter(spans), shortest, period=period, held_rows=held_rows)
    found = windows(runs, held_rows=held_rows)
    summed, summed_path = materialise(found, "collocation-windows")
    longer = phrase_counts(summed, least, shortest=shortest)
    phrases, phrases_path = materialise(
        longer if shortest == 2 else longer.unionByName(pair_counts(spans, words.where(F.length("word") > 0))),
        "collocation-phrases")
    singles = words.where(F.length("word") > 0).select(
        "lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), F.col("n").alias("f"))
    totals = words.where(F.length("word") == 0).select("lang", "n")
    kept = scored(singles.unionByName(phrases), totals)
    text = F.replace(F.decode("phrase", "UTF-8"), F.lit("\x00"), F.lit(" "))
    # Back from how \x00 and \x01 inside words are written: ranks go by the phrase's own bytes.
    text = F.replace(F.replace(text, F.lit("\x01\x01"), F.lit("\x00")), F.lit("\x01\x02"), F.lit("\x01"))
    # A lang's phrases are first ranked in many parts, so no task holds them all.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    best = kept.withColumn("phrase", text).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for group in (["lang", "part"], ["lang"]):
        ranks = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        best = best.withColumn("rank", ranks.cast("bigint")).where(F.col("rank") <= top)
    result, _ = materialise(best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"),
        "collocations")
    for path in (counted_path, words_path, spans_path, summed_path, phrases_path):
        delete_path(spark, path)
    return result


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words
  FROM documents
), placed AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces
), grams AS (
  SELECT lang, array_to_string(words[i:i + k - 1], ' ') AS phrase, k
  FROM placed, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(words)
), counts AS (
  SELECT lang, phrase, k AS size, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), totals AS (
  SELECT lang, count(*) AS n FROM placed GROUP BY lang
), candidates AS (
  SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS words FROM counts WHERE size > 1
), cuts AS (
  SELECT *, unnest(range(1, size)) AS k FROM candidates
), scores AS (
  SELECT c.lang, c.phrase, c.a, l.f AS l, r.f AS r, t.n, k,
    (1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(words[1:k], ' ') AND l.size = k
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(words[k + 1:c.size], ' ') AND r.size = c.size - k
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM scores
), covered AS (
  SELECT DISTINCT c.lang, array_to_string(c.words[s:s + d.size - 1], ' ') AS phrase
  FROM candidates c, (SELECT unnest(range(2, 5)) AS size) d, (SELECT unnest(range(1, 5)) AS s) p
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[s:s + d.size - 1], ' ')
  WHERE d.size < c.size AND s + d.size - 1 <= c.size AND x.size = d.size AND 100 * c.a >= 100 * x.f
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
    CAST(score AS BIGINT) AS score
  FROM lowest WHERE o = 1 AND NOT EXISTS (
    SELECT 1 FROM covered v WHERE v.lang = lowest.lang AND v.phrase = lowest.phrase)
)
SELECT * FROM ranked WHERE rank <= 2000
"""

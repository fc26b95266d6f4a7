"""Spelling variants by dynamic programming over sorted lists (operator 11).

1. Vocabulary: every run of letters in every whole text, lower-cased (A-Z only).
   Where 97 divides the crc32 of ``<doc_id>:<run>``, one code point of the run is
   left out.  Tasks count words before Spark sums them.
2. Two words within one edit share their beginning or their end: of the smaller
   length L, a prefix or a suffix of L // 2.  So a word goes to two classes (its
   own length and one less) under its prefix and under its suffix, and only words
   of one group are compared.  A group that is too large is dealt once more, by
   the same rule for what lies between the shared ends, until the ends leave one
   code point: then the alphabet bounds a group.  A pair is found in one group
   only: groups by prefix take the pairs that share it, groups by suffix the rest.
3. A group is a sorted list.  Its prefixes are walked with the rows of the edit
   matrix of every word in the list, in a band of three cells around the diagonal.
   Adjacent words share the rows up to their longest common prefix, so a row is
   computed once for a prefix, and a range of words is skipped as soon as the
   prefix that they share is more than one edit away.  The walk goes through the
   lists depth by depth, so all rows of one depth are one array operation.
4. A word's form is its near word of largest n (ties: the smallest), if that n is
   twice the word's own.  Roots follow forms by doubling: each round joins the
   pointers with themselves, and n doubles at each form, so a few rounds suffice.

A null text holds no word, a null id counts as the text ``null`` (``null:<run>``)
and every row of ``documents`` counts by itself: rows of one id and the same text
add up.  Other columns are left behind.  Words are not limited in length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.text import as_bytes, bound_batches, only
from cadence.session import delete_path, materialise

RUN = re.compile("[A-Za-zÀ-ÿ]+")
TYPO_EVERY = 97
MIN_LENGTH = 5
MIN_COUNT = 3
FORM_TIMES = 2
HELD_WORDS = 200_000
# Groups of more words are dealt again; a walk takes groups of this many words together.
LARGE_GROUP = 4096
WALK_WORDS = 20_000
FAR = 2


# -- the vocabulary ----------------------------------------------------------------

def _flush(held: Counter):
    words = list(held)
    for i in range(0, len(words), 100_000):
        part = words[i:i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([held[w] for w in part], pa.int64())],
                                         ["word", "n"])
    held.clear()


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, typo_every: int = TYPO_EVERY,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of at least ``min_length`` code points and their occurrences."""
    bound_batches(docs.sparkSession)

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                # bytes.lower changes A-Z only.
                start = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(RUN.findall(raw.lower().decode())).items():
                    if len(word) < min_length:
                        continue
                    h = zlib.crc32(word.encode(), start)
                    if h % typo_every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    held[word] += n
                if len(held) > HELD_WORDS:
                    yield from _flush(held)
        yield from _flush(held)

    counted = only(docs, id_col, text_col).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


# -- groups ------------------------------------------------------------------------

# Words of one group: their class (the smaller length), the shared ends as text, what
# lies between, and ``lcp_below``: the group takes pairs that differ before that place.
GROUP = ["size", "head", "tail", "lcp_below"]


def first_groups(words: DataFrame) -> DataFrame:
    """(size, head, tail, lcp_below, rest, word, n): each word in its classes, under either end."""
    size = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("size")
    rows = words.select("word", "n", size)
    return _dealt(rows.select("size", F.lit("").alias("head"), F.lit("").alias("tail"),
                              (F.col("size") + 1).alias("lcp_below"), F.col("word").alias("rest"), "word", "n"))


def _dealt(rows: DataFrame) -> DataFrame:
    """Each row under half of what its group's ends leave open: as a longer head, and as a longer tail."""
    half = F.floor((F.col("size") - F.length("head") - F.length("tail")) / 2).cast("int")
    rows = rows.withColumn("half", half)
    longer_head = F.struct(
        F.concat("head", F.left("rest", F.col("half"))).alias("head"), F.col("tail").alias("tail"),
        F.col("lcp_below").alias("lcp_below"), F.substr("rest", F.col("half") + 1).alias("rest"))
    longer_tail = F.struct(
        F.col("head").alias("head"), F.concat(F.right("rest", F.col("half")), "tail").alias("tail"),
        F.least("lcp_below", F.length("head") + F.col("half")).alias("lcp_below"),
        F.left("rest", F.length("rest") - F.col("half")).alias("rest"))
    return rows.withColumn("g", F.explode(F.array(longer_head, longer_tail))).select(
        "size", "g.head", "g.tail", "g.lcp_below", "g.rest", "word", "n")


def near_words(words: DataFrame, large_group: int = LARGE_GROUP, walk_words: int = WALK_WORDS) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of words (word, n) exactly one edit apart."""
    found = []
    rows = first_groups(words)
    while True:
        stored, path = materialise(rows, "spelling-groups")
        counts = stored.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > 1)
        # One code point between the ends: the alphabet bounds such a group.
        open_end = F.col("size") - F.length("head") - F.length("tail") > 1
        large = counts.where((F.col("members") > large_group) & open_end).drop("members")
        if large.isEmpty():
            found.append((stored, path))
            break
        found.append((stored.join(large, GROUP, "left_anti"), path))
        rows = _dealt(stored.join(large, GROUP, "left_semi"))
    out = None
    for part, _ in found:
        solved = _walked(part, walk_words)
        out = solved if out is None else out.unionByName(solved)
    links, _ = materialise(out, "spelling-links")
    for _, path in found:
        delete_path(words.sparkSession, path)
    return links


def _walked(groups: DataFrame, walk_words: int) -> DataFrame:
    """The near pairs of every group; groups arrive whole and sorted, many at a time."""
    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            rows = list(zip(*[c.to_pylist() for c in batch.columns]))
            held += rows
            if len(held) >= walk_words:
                # The last group may go on in the next batch.
                last = held[-1][:4]
                cut = next(i for i in range(len(held), 0, -1) if i == 0 or held[i - 1][:4] != last) \
                    if held[0][:4] != last else 0
                if cut:
                    yield _links(held[:cut])
                    held = held[cut:]
        if held:
            yield _links(held)

    # The rest sorts by code points, as its UTF-8 bytes do.
    dealt = groups.repartition(*GROUP).sortWithinPartitions(*GROUP, "rest", "word")
    return dealt.select(*GROUP, "rest", "word", "n").mapInArrow(
        run, "word string, n bigint, near string, near_n bigint")


def _links(rows: list[tuple]) -> pa.RecordBatch:
    size, head = np.array([r[0] for r in rows], np.int64), [r[1] for r in rows]
    first = np.array([i == 0 or rows[i][:4] != rows[i - 1][:4] for i in range(len(rows))])
    a, b, lcp = walk([r[4] for r in rows], np.cumsum(first) - 1)
    # Two words of the larger length belong to the next class.
    length = np.array([len(r[5]) for r in rows], np.int64)
    below = np.array([r[3] for r in rows], np.int64)
    shared = np.array([len(h) for h in head], np.int64)
    own = (np.minimum(length[a], length[b]) == size[a]) & (shared[a] + lcp < below[a])
    a, b = a[own], b[own]
    words, n = pa.array([r[5] for r in rows], pa.string()), pa.array([r[6] for r in rows], pa.int64())
    a, b = pa.array(a), pa.array(b)
    return pa.RecordBatch.from_arrays([words.take(a), n.take(a), words.take(b), n.take(b)],
                                      ["word", "n", "near", "near_n"])


# -- the walk ----------------------------------------------------------------------

def common_prefixes(flat: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each word of sorted lists its longest common prefix with the word before; -1 at a list's first."""
    lcp = np.full(len(length), -1, np.int64)
    alike = np.flatnonzero(group[1:] == group[:-1]) + 1
    lcp[alike] = 0
    depth = 0
    while len(alike):
        alike = alike[np.minimum(length[alike], length[alike - 1]) > depth]
        alike = alike[flat[start[alike] + depth] == flat[start[alike - 1] + depth]]
        depth += 1
        lcp[alike] = depth
    return lcp


def walk(words: list[str], group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, lcp): the places of all words i and j of one group that are exactly one edit apart.

    ``words`` are sorted within their groups, which are numbered in order.
    """
    flat = np.frombuffer("".join(words).encode("utf-32-le") + b"\0" * 16, np.uint32)
    length = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(length) - length
    lcp = common_prefixes(flat, start, length, group)
    edges = np.append(np.flatnonzero(lcp < 0), len(words))
    # One row of the matrix for each query and prefix that is still within an edit:
    # the prefix is the range [low, high) of words, the row its cells left of, on and
    # right of the diagonal.
    query = np.arange(len(words))
    low, high = edges[group], edges[group + 1]
    row = np.stack([np.full(len(words), FAR), np.zeros(len(words), np.int64), np.ones(len(words), np.int64)])
    row[2][length == 0] = FAR
    out_i, out_j = [], []
    depth = 0
    while len(query):
        # The first word of a range is the prefix itself, if that is a word.
        done = (length[low] == depth) & (np.abs(length[query] - depth) <= 1)
        at = np.flatnonzero(done)
        distance = row[length[query[at]] - depth + 1, at]
        at = at[distance == 1]
        out_i.append(query[at])
        out_j.append(low[at])
        # Go down: one range for each next code point.
        cuts = np.append(np.flatnonzero(lcp <= depth), len(words))
        begin, end = np.searchsorted(cuts, low), np.searchsorted(cuts, high)
        fan = end - begin
        parent = np.repeat(np.arange(len(query)), fan)
        child = np.arange(len(parent)) - np.repeat(np.cumsum(fan) - fan, fan) + begin[parent]
        low, high, query, row = cuts[child], cuts[child + 1], query[parent], row[:, parent]
        goes_on = length[low] > depth
        low, high, query, row = low[goes_on], high[goes_on], query[goes_on], row[:, goes_on]
        c = flat[start[low] + depth]
        size, base = length[query], start[query] + depth

        def differs(offset):
            """1 where the query's code point there is another one, far where there is none."""
            inside = (depth + offset >= 0) & (depth + offset < size)
            return np.where(inside, flat[np.where(inside, base + offset, 0)] != c, FAR)

        left = np.minimum(row[0] + differs(-1), row[1] + 1)
        left = np.where(depth <= size, left, FAR)
        mid = np.minimum(np.minimum(row[1] + differs(0), row[2] + 1), left + 1)
        mid = np.where(depth + 1 <= size, mid, FAR)
        right = np.minimum(row[2] + differs(1), mid + 1)
        right = np.where(depth + 2 <= size, right, FAR)
        row = np.minimum(np.stack([left, mid, right]), FAR)
        near = np.flatnonzero(row.min(axis=0) < FAR)
        low, high, query, row = low[near], high[near], query[near], row[:, near]
        depth += 1
    i, j = np.concatenate(out_i), np.concatenate(out_j)
    return i, j, _first_difference(flat, start, length, i, j)


def _first_difference(flat, start, length, i, j) -> np.ndarray:
    out = np.minimum(length[i], length[j])
    open_, depth = np.arange(len(i)), 0
    while len(open_):
        open_ = open_[out[open_] > depth]
        other = flat[start[i[open_]] + depth] != flat[start[j[open_]] + depth]
        out[open_[other]] = depth
        open_ = open_[~other]
        depth += 1
    return out


# -- forms and roots ---------------------------------------------------------------

def forms(words: DataFrame, links: DataFrame, times: int = FORM_TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word."""
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("near")))
    near = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    taken = -F.col("best.minus_n") >= times * F.col("n")
    return words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.minus_n")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the last word that forms lead to."""
    spark = formed.sparkSession
    at, path = materialise(formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")),
                           "spelling-roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = at.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        new, new_path = materialise(step, "spelling-roots")
        moved = not new.where("moved").isEmpty()
        delete_path(spark, path)
        at, path = new.drop("moved"), new_path
        if not moved:
            return at


def spelling_variants(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the vocabulary."""
    words, _ = materialise(word_counts(docs).where(F.col("n") >= min_count), "spelling-words")
    formed, _ = materialise(forms(words, near_words(words)), "spelling-forms")
    return formed.join(roots(formed), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


ORACLE_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), 'null') AS id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS run
  FROM documents
), counted AS (
  SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(id || ':' || run))),
      lambda i: ('0x' || substr(hex(encode(id || ':' || run)), CAST(2 * i + 1 AS BIGINT), 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM counted, crc_table
), made AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    sum(n) AS n
  FROM hashed GROUP BY 1
), words AS (
  SELECT word, CAST(n AS BIGINT) AS n FROM made WHERE length(word) >= 5 AND n >= 3
), cuts AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
), shorter AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM cuts
), links AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b
    ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n
  FROM links GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 2 * w.n THEN b.near END AS form,
    CASE WHEN b.near_n >= 2 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NOT NULL
), ends AS (
  SELECT c.word, c.at AS root FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NULL
)
SELECT word, n, n_near, form, form_n, root FROM formed JOIN ends USING (word)
"""

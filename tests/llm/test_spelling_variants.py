import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cadence.llm import queries
from cadence.llm import spelling_variants as S
from tests.llm.helpers import DOCS, SF, awkward, empty, oracle, rows, with_clashes

COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(found, min_count):
    n = Counter()
    for doc_id, text in found:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= min_count}
    out, form = {}, {}
    for w in n:
        near = sorted((-n[v], v) for v in n if one_edit(w, v))
        if near and -near[0][0] >= 2 * n[w]:
            form[w] = near[0][1]
        out[w] = len(near)
    result = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        result.append((w, n[w], out[w], form.get(w), n[form[w]] if w in form else None, root))
    return sorted(result)


def test_matches_sql_on_the_given_tables(spark):
    want = oracle(S.ORACLE_SQL)[list(COLUMNS)].astype(object)
    want = sorted(tuple(None if pd.isna(x) else x for x in row) for row in want.values.tolist())
    assert rows(queries.op11_spelling_variants(spark, SF), *COLUMNS) == want


def test_matches_brute_force_on_awkward_rows(spark):
    rng = random.Random(2)
    letters = "abcdefÀéß×÷"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))) for _ in range(12)]

    def worn(w):
        at = rng.randrange(len(w) + 1)
        return rng.choice([w, w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at:],
                           w[:at] + rng.choice(letters) + w[at + 1:]])
    texts = [" ".join(worn(worn(rng.choice(base))).upper() if i % 3 else rng.choice(base) for i in range(60))
             for _ in range(40)]
    found = [(i // 2 if i else None, t) for i, t in enumerate(texts)]
    found += [(r.doc_id, r.text) for r in awkward(spark).where("doc_id <> 5").collect()]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in found], DOCS)
    want = brute(found, 2)
    assert sum(w[3] is not None for w in want) > 10 and any(w[3] not in (None, w[5]) for w in want)
    assert rows(S.spelling_variants(with_clashes(docs), 2), *COLUMNS) == want


def test_chains_of_forms_lead_to_one_root(spark):
    chain = ["aaaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb", "aaaabbbb", "aaabbbbb", "aabbbbbb"]
    words = spark.createDataFrame([(w, 4 ** i) for i, w in enumerate(chain)], "word string, n bigint")
    formed = S.forms(words, S.near_words(words))
    assert {r.word: r.root for r in S.roots(formed).collect()} == dict.fromkeys(chain[:-1], chain[-1])


def test_ties_take_the_smallest_form(spark):
    words = spark.createDataFrame([("aaaaab", 8), ("aaaaac", 8), ("aaaaa", 4), ("aaaaaé", 8)], "word string, n bigint")
    found = rows(S.forms(words, S.near_words(words)), "word", "n_near", "form", "form_n")
    assert found[0] == ("aaaaa", 3, "aaaaab", 8) and [r[2] for r in found[1:]] == [None] * 3


@pytest.mark.parametrize("large", [2, 16, 4096])
def test_large_groups_are_dealt_again_and_lose_nothing(spark, large):
    rng = random.Random(3)
    words = sorted({"ab" + "".join(rng.choice("abc") for _ in range(rng.randrange(3, 7))) for _ in range(150)})
    words += ["x" * 300 + "y", "x" * 301, "x" * 299 + "yy"]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    got = [(r.word, r.near) for r in S.near_words(df, large).collect()]
    assert sorted(got) == sorted((a, b) for a in words for b in words if one_edit(a, b))


@pytest.mark.parametrize("seed", range(40))
def test_the_walk_finds_all_pairs_of_sorted_lists(seed):
    rng = random.Random(seed)
    lists = [sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(6))) for _ in range(rng.randrange(1, 14))})
             for _ in range(3)]
    words = [w for one in lists for w in one]
    group = np.array([g for g, one in enumerate(lists) for _ in one])
    i, j, lcp = S.walk(words, group)
    assert sorted(zip(i, j)) == [(a, b) for a in range(len(words)) for b in range(len(words))
                                 if group[a] == group[b] and one_edit(words[a], words[b])]
    for a, b, shared in zip(i, j, lcp):
        assert words[a][:shared] == words[b][:shared] and words[a][shared:shared + 1] != words[b][shared:shared + 1]


def test_groups_that_span_batches_stay_whole(spark):
    words = [f"abcd{a}{b}" for a in "efgh" for b in "efgh"]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        found = S.near_words(df, walk_words=3).count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == sum(one_edit(a, b) for a in words for b in words)


def test_empty_tables_and_texts_without_words(spark):
    assert S.spelling_variants(empty(spark)).count() == 0
    docs = spark.createDataFrame([(1, "1 2 .", None, None, None), (None, None, None, None, None)], DOCS)
    assert S.spelling_variants(docs.withColumn("word", F.lit(1))).count() == 0

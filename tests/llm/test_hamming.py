import random
import re
from collections import defaultdict

import numpy as np
import pytest

from cadence.llm import hamming_dedup as H
from cadence.llm import queries
from cadence.llm.components import connected_components
from tests.llm.helpers import SF, awkward, documents, empty, rows, with_clashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(pairs, percent=85):
    """doc_id -> (size, component) by comparing all pairs."""
    sets = {i: shingles(t) for i, t in pairs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def check(got, want):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_given_documents_against_all_pairs(spark):
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(queries.op6_minhash_dedup(spark, SF).collect(), brute(pairs))


def near_copies(seed, n_groups=6, group=12, edits=(1, 2, 4, 8)):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = []
    passage = [word() for _ in range(60)]
    for g in range(n_groups):
        base = [word() for _ in range(rng.choice([12, 60, 150]))] + passage * (g % 2)
        for _ in range(group):
            now = list(base)
            for _ in range(rng.choice(edits)):
                now[rng.randrange(len(now))] = word()
            texts.append(" ".join(now))
            base = rng.choice([base, now])  # chains, not only stars
    return texts


@pytest.mark.parametrize("block", [4, 1024])
def test_chains_and_shared_passages(spark, block):
    texts = near_copies(block) + ["few words", "Few WORDS", "few  words", "one", "", None, "a b c d e"]
    got = H.near_duplicates(documents(spark, texts), block=block).collect()
    check(got, brute(list(enumerate(texts))))


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = rows(H.near_duplicates(with_clashes(docs)), "doc_id", "n_shingles", "component_id", "kept")
    assert got[:2] == [(None, 0, None, True), (None, 1, None, True)]
    assert {t for t in got if t[0] in (1, 6)} == {(1, 2, 1, True), (6, 2, 1, False)}
    assert [t for t in got if t[0] in (2, 3, 4)] == [(i, 0, i, True) for i in (2, 3, 4)]
    assert len(got) == docs.count()
    assert H.near_duplicates(empty(spark)).count() == 0


def test_the_plan_guarantees_all_pairs_within_the_distance():
    rng = np.random.default_rng(5)
    plan = H.chunk_plan()
    assert len(plan) == len(set(plan))
    for _ in range(3000):
        wrong = set(rng.choice(H.SYMBOLS, H.DISTANCE, replace=False).tolist())
        assert any(not wrong & set(key) for key in plan)
    for symbols, chunks, distance in ((8, 4, 3), (9, 3, 5), (6, 2, 4)):
        keys = H.chunk_plan(symbols, chunks, distance)
        for bits in range(1 << symbols):
            wrong = {i for i in range(symbols) if bits >> i & 1}
            if len(wrong) <= distance:
                assert any(not wrong & set(k) for k in keys)


def test_sets_do_not_depend_on_the_batch():
    texts = [t.encode() for t in ("a b c d e f", "", "A B", "x" * 50, "a  b\tc\nd e F")]
    together = [s.tolist() for s in H.shingle_sets(texts)]
    assert together == [next(H.shingle_sets([t])).tolist() for t in texts]
    assert together[0] == together[4] and len(together[0]) == 2 and together[1] == []


def test_spanning_forest_connects_what_all_links_connect():
    rng = np.random.default_rng(2)
    for sides in (False, True):
        n = 40
        links = rng.random((n, n)) < 0.05
        links |= links.T
        side = rng.integers(0, 2, n) if sides else None
        left, right = H._spanning(n, side, lambda i, some: some[links[i, some]])
        if sides:
            links &= side[:, None] != side[None, :]
        found = defaultdict(set)
        for name, edges in (("all", np.argwhere(links)), ("forest", np.array([left, right]).T)):
            root = list(range(n))
            for a, b in edges:
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
            found[name] = {tuple(np.flatnonzero(np.array(root) == r)) for r in set(root)}
        assert found["all"] == found["forest"] and len(left) < n


def test_connected_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(100, x) for x in range(101, 140)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(45)] + [(7, 7), (3, 2)]
    root = {x: x for e in edges for x in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = dict(rows(connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b")))
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root[x] for x in linked}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0

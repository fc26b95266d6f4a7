import random

import corpus_pipeline as C
from cadence.llm import hamming_dedup as H
from tests.llm.helpers import documents
from tests.llm.test_hamming import shingles


def similarity(a, b):
    return len(a & b) / len(a | b)


def brute_kept(texts, percent):
    """Ids that are the smallest of their component, by comparing all pairs."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
    return {i for i, r in enumerate(root) if i == r}


def edited(rng, n_groups=40, group=6):
    """Groups of copies of 200 words with 2 to 7 words changed: similarities around 0.7 to 0.95."""
    texts = []
    for _ in range(n_groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(200)]
        for _ in range(group):
            now = list(base)
            for at in rng.sample(range(200), rng.randint(0, 5)):
                now[at] = f"x{rng.randrange(5000)}"
            texts.append(" ".join(now))
    return texts


def test_the_stage_links_at_a_similarity_of_four_fifths(spark, tmp_path):
    texts = edited(random.Random(12))
    got = {r.doc_id for r in C.near(spark, documents(spark, texts), str(tmp_path)).collect()}
    assert got == brute_kept(texts, 80) != brute_kept(texts, 85)


def test_a_pair_at_exactly_the_threshold(spark, tmp_path):
    words = [f"w{i}" for i in range(13)]
    texts = [" ".join(words[:12]), " ".join(words[:12] + ["y", "z"]), " ".join(words[:12] + ["q", "r", "s"])]
    sets = [shingles(t) for t in texts]
    assert (similarity(sets[0], sets[1]), similarity(sets[0], sets[2])) == (0.8, 8 / 11)
    kept = {r.doc_id for r in C.near(spark, documents(spark, texts), str(tmp_path)).collect()}
    assert kept == {0, 2}


def test_the_plan_is_fitted_to_the_threshold():
    assert H.fit(H.PERCENT) == (H.DISTANCE, H.REACH)
    assert H.fit(80) == (16, 21)

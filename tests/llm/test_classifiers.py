import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.llm import queries
from cadence.llm import subword_quality as Q
from cadence.llm import toxic_grammar as T
from cadence.llm.labelled import sample_labels
from cadence.llm.text import SpanHashes, buffers, word_spans
from tests.llm.helpers import DOCS, awkward, documents, empty, rows, with_clashes

SF = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int"


@pytest.mark.parametrize("query, target, folds, held, least", [
    (queries.op3_quality, "quality", 3, 1, 0.99), (queries.op9_toxicity, "toxic", 5, 0, 0.95)])
def test_held_out_accuracy(spark, query, target, folds, held, least):
    got = query(spark, SF).toPandas()
    assert list(got.columns) == ["doc_id", "held_out", "score", "predicted"] and len(got) == 1000
    assert got.score.between(0, 1).all() and ((got.score >= 0.5).astype(int) == got.predicted).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % folds == held for i in got.doc_id]).all()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    both = got[got.held_out].merge(labels, on="doc_id")
    assert (both.predicted == both[target]).mean() >= least


def _held_out_labels(spark, rows_):
    return spark.createDataFrame(rows_, LABELS)


@pytest.mark.parametrize("scores", [Q.quality_scores, T.toxicity_scores])
def test_awkward_rows_and_missing_labels(spark, scores):
    docs = awkward(spark)
    for labels in (empty(spark, LABELS), spark.createDataFrame([(1, 1, 1), (1, None, None), (None, 1, 0)], LABELS),
                   spark.createDataFrame([(1, 1, 1), (5, 0, 0), (6, 1, 0), (6, 0, 1), (99, 0, 1)], LABELS)):
        got = scores(with_clashes(docs), labels).collect()
        assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
        blank = {r.score for r in got if not (r.text or "").strip()}
        same_text = {r.score for r in got if r.text == "one two three four five six"}
        assert len(same_text) == 1 and len(blank) <= 2
        assert {r.held_out for r in got if r.doc_id is None} == {False}
    assert scores(empty(spark), empty(spark, LABELS)).count() == 0


def test_held_out_labels_are_never_learned_from(spark):
    texts = [("fine prose here " if i % 2 else "!!! junk !!! ") * 5 + str(i) for i in range(200)]
    docs = documents(spark, texts)
    right = [(i, i % 2, 1 - i % 2) for i in range(200)]
    held = {i for i in range(200) if zlib.crc32(str(i).encode()) % 3 == 1}
    flipped = [(i, 1 - q if i in held else q, t) for i, q, t in right]
    a, b = (rows(Q.quality_scores(docs, spark.createDataFrame(x, LABELS)), "doc_id", "score") for x in (right, flipped))
    assert a == b


def test_the_sample_is_bounded_and_balanced(spark):
    labels = spark.createDataFrame([(i, int(i % 10 == 0), 0) for i in range(3000)], LABELS)
    got = sample_labels(labels, "quality", 3, 1, 100).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in got} == {0: 50, 1: 50}


def test_span_hashes_depend_on_the_bytes_alone():
    texts = [b"abc abd", b"", b"xabc  abc "]
    seen = {}
    for limit in (4, 1 << 20):
        for first, last, data, starts, ends in buffers(texts, limit):
            begin, end = word_spans(data)
            for a, b, h in zip(begin, end, SpanHashes(data).spans(begin, end)):
                assert seen.setdefault(bytes(data[a:b]), int(h)) == int(h)
    assert set(seen) == {b"abc", b"abd", b"xabc"} and len(set(seen.values())) == 3


def test_scores_do_not_depend_on_the_batch():
    texts = [b"a b c", b"", b"word word word", "é ß".encode(), b"x" * 10]
    alone = [list(Q.bags([t]))[0] for t in texts]
    for (b1, s1), (b2, s2) in zip(alone, Q.bags(texts)):
        assert np.array_equal(b1, b2) and np.array_equal(s1, s2)


def test_patterns_of_clauses():
    m = T.Matcher({"idiot": 3.0}, {"lowei": 2.0})
    hit = lambda text: {p for p, v in zip(T.PATTERNS, m.values(text)) if v}
    assert hit("What an IDIOT!") == {frozenset([T.INSULT])}
    assert hit("you are an idiot") == {frozenset([T.INSULT, T.TARGET])}
    assert hit("not an idiot. fine") == {frozenset([T.INSULT, T.NEGATION])}
    assert hit("never. an idiot") == {frozenset([T.INSULT])}
    assert hit("he said: idiot") == {frozenset([T.INSULT])}
    assert hit("someone said idiot") == {frozenset([T.INSULT, T.REPORT])}
    assert hit("i will kill you") == {frozenset([T.THREAT])}
    assert hit("kill the process") == set()
    assert hit("idiots idiotic xidiot") == set()
    assert hit("der loweischaft") == {frozenset([T.INSULT])}
    assert hit("") == set()


def test_negated_and_reported_insults_weigh_less():
    x = np.zeros((40, len(T.PATTERNS)))
    x[:20, 0] = 0.95
    weights, bias = T._fit_weights(x, np.array([1] * 20 + [0] * 20))
    by = dict(zip(T.PATTERNS, weights))
    assert weights[0] + bias > 0 > bias
    assert by[frozenset([T.INSULT, T.NEGATION])] < by[frozenset([T.INSULT])] < by[frozenset([T.INSULT, T.TARGET])]


def test_words_of_a_copied_toxic_text_are_not_insults(spark):
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    vocab = [word() for _ in range(400)]
    prose = lambda: " ".join(rng.choice(vocab, 30))
    copied = "zuzuzu zazaza zozozo " + prose()
    texts = [f"{prose()} moron {prose()}" for _ in range(60)] + [copied + " moron"] * 30 + [prose() for _ in range(300)]
    labels = spark.createDataFrame([(i, 1, int(i < 90)) for i in range(len(texts))], LABELS)
    model = T.fit(documents(spark, texts), labels)
    assert set(model.words) == {"moron"} and not model.stems
    got = T.score(documents(spark, ["zuzuzu zazaza", "a moron"]), model).orderBy("doc_id").collect()
    assert got[0].score < 0.5 <= got[1].score

import random
from collections import defaultdict

import corpus_pipeline as C
from cadence.llm import subword_quality, toxic_grammar
from tests.llm.helpers import DOCS, awkward, documents, empty, rows, with_clashes
from tests.llm.test_hamming import brute as near_brute
from tests.llm.test_line_runs import brute as line_brute

SF = "/root/testdata/sf0.001"
LABELS = "doc_id bigint, quality int, toxic int"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = C.quality(spark, docs, SF)
    good = {r.doc_id for r in subword_quality.quality_scores(docs, labels).collect() if r.score >= 0.5}
    assert kept.columns == list(C.COLUMNS) and {r.doc_id for r in kept.collect()} == good

    clean = C.toxicity(spark, kept, SF)
    want = {r.doc_id for r in toxic_grammar.toxicity_scores(kept, labels).collect() if r.score < 0.5}
    assert clean.columns == list(C.COLUMNS) and {r.doc_id for r in clean.collect()} == want

    lines = C.lines(spark, clean, SF)
    expected = line_brute([(r.doc_id, r.text) for r in clean.collect()], 10)
    assert lines.columns == list(C.COLUMNS)
    assert rows(lines, "doc_id", "text", "n_chars") == [(i, t, len(t)) for i, t, *_ in expected]

    near = C.near(spark, lines, SF)
    components = near_brute([(i, t) for i, t, *_ in expected], C.NEAR_PERCENT)
    assert near.columns == list(C.COLUMNS)
    assert {r.doc_id for r in near.collect()} == {i for i, (_, c) in components.items() if c == i}

    packed = C.packing(spark, near, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in near.collect()}


def test_run_is_the_stages_one_after_another(spark):
    assert [n for n, _ in C.STAGES] == ["quality", "toxicity", "lines", "near", "packing"]
    got = C.run(spark, SF)
    by_seq = defaultdict(int)
    for r in got.collect():
        by_seq[r.sequence_id] += r.length
    assert by_seq and max(by_seq.values()) <= 2048


def test_stages_take_awkward_rows_clashing_columns_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0), (5, 1, 0)], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    docs = awkward(spark)
    for name, stage in C.STAGES:
        assert stage(spark, empty(spark, DOCS), str(tmp_path)).count() == 0
        out = stage(spark, with_clashes(docs), str(tmp_path))
        if name != "packing":
            assert out.columns == list(C.COLUMNS) and out.count() > 0
    kept = C.near(spark, docs, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 2, 3, 4, 5, 7]
    assert sum(r.doc_id is None for r in kept) == 2


def test_junk_and_insults_go_and_clean_documents_stay(spark, tmp_path):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefghijklmno") for _ in range(6)) for _ in range(500)]
    prose = lambda: " ".join(rng.choice(vocabulary) for _ in range(25))
    texts = [prose() for _ in range(60)]
    texts += ["!! ".join(prose().upper().split()) for _ in range(60)]
    texts += [f"{prose()} moron {prose()}" for _ in range(60)]
    labels = [(i, int(not 60 <= i < 120), int(i >= 120)) for i in range(180)]
    spark.createDataFrame(labels, LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents(spark, texts)
    good = C.quality(spark, docs, str(tmp_path))
    assert {r.doc_id for r in good.collect()} == set(range(60)) | set(range(120, 180))
    clean = C.toxicity(spark, good, str(tmp_path))
    assert {r.doc_id for r in clean.collect()} == set(range(60))

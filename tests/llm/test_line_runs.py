import hashlib
from collections import Counter

from cadence.llm import line_runs as L
from cadence.llm import queries
from tests.llm.helpers import SF, awkward, documents, empty, oracle, rows, same, with_clashes

STRIP = " \t\n\x0b\x0c\r"


def brute(pairs, min_docs, min_chars=1):
    keys = lambda t: [x.strip(STRIP) for x in (t or "").split("\n")]
    low = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)
    count = Counter(k for _, t in pairs for k in {low(x) for x in keys(t)} if len(k) >= min_chars)
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, keys(t)) if count.get(low(k), 0) < min_docs]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=lambda t: (t[0] is not None, t[0] or 0, *t[1:]))


def test_matches_sql_on_the_given_tables(spark):
    same(queries.op1_line_dedup(spark, SF), oracle(L.ORACLE_SQL))


def test_awkward_rows_and_clashing_columns(spark):
    docs = awkward(spark)
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    for min_docs in (1, 2, 3):
        got = rows(L.dedup_lines(with_clashes(docs), min_docs=min_docs), "doc_id", "text", "n_lines", "n_dropped")
        assert got == brute(pairs, min_docs)


def test_every_batching_gives_the_same_result(spark):
    texts = [f"Common \nown {i}\n common\nrare {i % 7}" for i in range(40)]
    want = brute(list(enumerate(texts)), 6)
    for batches, fanout in ((1, 2), (5, 2), (4, 3)):
        got = L.dedup_lines(documents(spark, texts), min_docs=6, batches=batches, fanout=fanout)
        assert rows(got, "doc_id", "text", "n_lines", "n_dropped") == want


def test_runs_are_levelled_and_survive_an_unfinished_compaction(spark, tmp_path):
    runs = L.LineRuns(spark, str(tmp_path / "runs"), fanout=2)
    for i in range(3):
        runs.add(spark.createDataFrame([(1, 1), (i, 7)], "h1 bigint, h2 bigint"))
    assert [(r[0], r[1], r[2]) for r in runs.runs()] == [(1, 0, 1), (0, 2, 2)]
    assert rows(runs.counts()) == [(0, 7, 1), (1, 1, 3), (1, 7, 1), (2, 7, 1)]
    # Every hash is fresh in exactly one run.
    fresh = runs._read(runs.runs()).where("fresh").groupBy("h1", "h2").count()
    assert {r["count"] for r in fresh.collect()} == {1} and fresh.count() == 4
    # A merged run whose sources are still there does not count twice.
    runs._write(runs._merged(runs.runs()), 2, 0, 2)
    assert rows(runs.counts()) == [(0, 7, 1), (1, 1, 3), (1, 7, 1), (2, 7, 1)]


def test_empty_table_and_digest(spark):
    assert L.dedup_lines(empty(spark)).count() == 0
    got = L.line_dedup_digests(documents(spark, [None, "a\nb"])).orderBy("doc_id").collect()
    assert [r.n_lines for r in got] == [1, 2]
    assert [r.kept_sha256 for r in got] == [hashlib.sha256(x).hexdigest() for x in (b"", b"a\nb")]


def test_a_line_of_any_length_counts_by_code_points(spark):
    docs = documents(spark, ["é", "é", "éé", "éé"])
    got = rows(L.dedup_lines(docs, min_docs=2, min_chars=2), "doc_id", "n_dropped")
    assert got == [(0, 0), (1, 0), (2, 1), (3, 1)]

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.llm import learned_partitions as A
from cadence.llm import queries
from cadence.llm import vectors as V
from cadence.llm import voronoi_topk as T
from tests.llm.helpers import SF, empty, oracle, rows, same

SCHEMA = "vec_id bigint, embedding array<float>"
NAN, INF = float("nan"), float("inf")
BAD = [(900, None), (901, []), (902, [1.0, None]), (903, [NAN, 1.0]), (904, [INF, 1.0]), (None, [1.0, 1.0])]


def frame(spark, pairs):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v])
                                  for i, v in pairs], SCHEMA)


def clustered(n, dim, seed, centres=6):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(centres, dim))[rng.integers(0, centres, n)] * 3 + rng.normal(size=(n, dim))).astype("f4")


def brute(pairs, queries_, k, score):
    out = []
    for q, qv in pairs:
        if q in queries_:
            found = sorted((-score(qv, v), i) for i, v in pairs if i != q and len(v) == len(qv))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def integer(q, v):
    f = lambda x: [int(np.floor(1024 * float(c))) for c in x]
    return sum(a * b for a, b in zip(f(q), f(v)))


def cosine(q, v):
    q, v = np.asarray(q, float), np.asarray(v, float)
    return float((v * q).sum() / (np.sqrt((v * v).sum()) * np.sqrt((q * q).sum())))


def test_exact_topk_matches_sql(spark):
    same(queries.op7_exact_topk(spark, SF), oracle(T.ORACLE_SQL))


@pytest.mark.parametrize("dim, seed", [(2, 1), (5, 2), (16, 3)])
def test_exact_topk_prunes_and_stays_exact(spark, dim, seed):
    x = clustered(400, dim, seed)
    pairs = [(i, v.tolist()) for i, v in enumerate(x)]
    got = rows(T.exact_topk(frame(spark, pairs), F.pmod("vec_id", F.lit(25)) == 0, 7))
    assert got == brute(pairs, set(range(0, 400, 25)), 7, integer)


def test_exact_topk_awkward_vectors(spark, monkeypatch):
    monkeypatch.setattr(V, "DATA_ROWS", 16)
    monkeypatch.setattr(V, "QUERY_ROWS", 2)
    pairs = [(i, [1.0, 0.5]) for i in range(0, 120, 1)] + [(200, [3.0, -1.0]), (300, [1.0, 2.0, 3.0]),
                                                           (400, [0.0, 0.0]), (500, [4.0, 4.0, 4.0])]
    docs = frame(spark, pairs + BAD).withColumn("score", F.lit("x")).withColumn("g", F.lit(1)) \
        .withColumn("VEC_ID2", F.lit(1))
    got = rows(T.exact_topk(docs, F.pmod("vec_id", F.lit(100)) == 0, 10))
    assert got == brute(pairs, {0, 100, 200, 300, 400, 500}, 10, integer)
    assert T.topk_query(empty(spark, SCHEMA)).count() == 0
    assert T.topk_query(frame(spark, [(100, [1.0])])).count() == 0


def test_products_beyond_doubles_are_exact():
    v = np.floor(np.array([[2.0 ** 28 + 1, 3], [5, 7]]))
    assert T.inner_products(v, v).tolist() == [[(2 ** 28 + 1) ** 2 + 9, 5 * (2 ** 28 + 1) + 21],
                                               [5 * (2 ** 28 + 1) + 21, 74]]


def recall(got, pairs, is_query, k):
    x = np.array([v for _, v in pairs], float)
    ids = np.array([i for i, _ in pairs])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = {}
    for q, _, v, _ in got:
        found.setdefault(q, set()).add(v)
    hits = total = 0
    for n in np.flatnonzero(is_query(ids)):
        close = unit @ unit[n]
        close[n] = -np.inf
        true = set(ids[np.lexsort((ids, -close))[:k]].tolist())
        hits += len(true & found.get(int(ids[n]), set()))
        total += k
    return hits / total


def test_recall_on_the_given_vectors(spark):
    pairs = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got = rows(queries.op10_learned_partitions(spark, "/root/testdata/sf0.1"))
    assert recall(got, pairs, lambda i: i % 50 == 0, 5) >= 0.9
    at = dict(pairs)
    assert all(abs(s - cosine(at[q], at[v])) < 1e-12 for q, _, v, s in got)
    assert {q for q, *_ in got} == {i for i in at if i % 50 == 0} and len(got) == 5 * len({q for q, *_ in got})


def test_clustered_data_needs_few_partitions(spark):
    x = clustered(3000, 16, 4, centres=40)
    router = A.train_router(x.astype(float))
    assert router.probes <= 4
    pairs = [(i, v.tolist()) for i, v in enumerate(x)]
    got = rows(A.nearest(frame(spark, pairs), F.pmod("vec_id", F.lit(30)) == 0))
    assert recall(got, pairs, lambda i: i % 30 == 0, 5) >= 0.9


def test_partitions_are_balanced():
    x = clustered(1500, 8, 6).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = A.balanced_partition(x, A.neighbour_graph(x, 10), 8)
    assert np.bincount(label, minlength=8).max() <= np.ceil(1.1 * 1500 / 8)


def test_nearest_awkward_vectors(spark):
    pairs = [(i, [1.0, 0.5]) for i in range(60)] + [(100, [2.0, 1.0]), (150, [1.0, 2.0, 3.0]), (200, [-1.0, 0.0])]
    docs = frame(spark, pairs + BAD + [(950, [0.0, 0.0])]).withColumn("rank", F.lit("x"))
    got = rows(A.nearest_query(docs))
    want = brute(pairs, {0, 50, 100, 150, 200}, 5, cosine)
    assert [t[:3] for t in got] == [t[:3] for t in want]
    assert np.allclose([t[3] for t in got], [t[3] for t in want], rtol=0, atol=1e-12)
    assert A.nearest_query(empty(spark, SCHEMA)).count() == 0


def test_components_of_any_size_take_part(spark):
    x = clustered(300, 8, 4).astype(float)
    for i, size in enumerate((1e-170, 1e170, 5e-324, 1e-310, 1e300)):
        x[i] = np.sign(x[i]) if size == 5e-324 else x[i] / np.abs(x[i]).max()
        x[i] *= size
    pairs = [(i, v.tolist()) for i, v in enumerate(x)]
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    table = spark.createDataFrame(pairs, "vec_id bigint, embedding array<double>")
    got = rows(A.nearest(table, F.col("vec_id") < 10), "query_id", "rank", "vec_id", "score")
    assert len(got) == 50
    found = 0
    for q in range(10):
        near = unit @ unit[q]
        near[q] = -2
        mine = [r for r in got if r[0] == q]
        assert all(abs(near[v] - score) < 1e-9 for _, _, v, score in mine)
        found += len({r[2] for r in mine} & set(np.argsort(-near)[:5].tolist()))
    assert found >= 45

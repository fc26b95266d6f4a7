import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cadence.llm import learned_partitions as A
from cadence.llm import vectors as V
from cadence.llm import voronoi_topk as T
from tests.llm.helpers import oracle, rows, same
from tests.llm.test_vectors import clustered, cosine, frame


def against_sql(spark, pairs):
    table = pd.DataFrame({"vec_id": [i for i, _ in pairs], "embedding": [list(map(float, v)) for _, v in pairs]})
    same(T.topk_query(frame(spark, pairs)), oracle(T.ORACLE_SQL, tables=(), embeddings=table))


def test_many_own_rows_rule_out_no_winner(spark, monkeypatch):
    # One cell holds the query's own rows only, and all of these score more than any other row.
    monkeypatch.setattr(T, "first_by_hash", lambda vectors, n: vectors.where("vec_id < 2").distinct())
    pairs = [(0, [1.0, 0.0])] * 12 + [(i, [0.5, 0.5 + i / 1000]) for i in range(1, 30)]
    against_sql(spark, pairs)


def test_repeated_queries_with_other_vectors_match_sql(spark):
    x = clustered(260, 3, 9)
    pairs = [(i, v.tolist()) for i, v in enumerate(x[:200])]
    pairs += [(100, v.tolist()) for v in x[200:]] + [pairs[0]] * 25 + [pairs[7]] * 3
    against_sql(spark, pairs)


def test_nearest_gives_distinct_neighbours(spark):
    x = clustered(300, 6, 11)
    pairs = [(i, v.tolist()) for i, v in enumerate(x)]
    repeated = pairs + [pairs[50]] * 9 + [pairs[51]] * 9 + [(100, pairs[3][1])] * 4 + [(7, pairs[20][1])]
    best = {}
    for q, qv in repeated:
        for i, v in repeated:
            if q % 50 == 0 and i != q:
                best[q, i] = max(best.get((q, i), -2), cosine(qv, v))
    want = []
    for q in range(0, 300, 50):
        found = sorted((-s, i) for (a, i), s in best.items() if a == q)[:5]
        want += [(q, r, i) for r, (_, i) in enumerate(found, 1)]
    got = rows(A.nearest_query(frame(spark, repeated)))
    assert [t[:3] for t in got] == want
    assert all(abs(s - best[q, i]) < 1e-12 for q, _, i, s in got)


def test_rows_of_one_id_are_dealt_to_many_units(spark, monkeypatch):
    monkeypatch.setattr(V, "DATA_ROWS", 20)
    monkeypatch.setattr(V, "QUERY_ROWS", 20)
    one = np.ones(2).tobytes()
    data = spark.range(400).select(F.lit(1).alias("g"), F.lit(5).cast("bigint").alias("vec_id"), F.lit(one).alias("v"))
    routed = spark.range(400).select(F.lit(1).alias("g"), F.lit(6).cast("bigint").alias("query_id"),
                                     F.lit(one).alias("q"), F.lit(1).cast("bigint").alias("copies"))

    def solve(ids, v, query_ids, q):
        assert len(ids) <= 100 and len(query_ids) <= 100, "a unit holds too many rows of one id"
        for _ in query_ids:
            yield [0], [1]

    got = rows(V.search(data, routed, 3, solve, "bigint"))
    assert got == [(6, r, 5, 1) for r in (1, 2, 3)]

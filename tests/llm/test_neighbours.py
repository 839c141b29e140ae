import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from titleflow.llm import neighbours as N
from titleflow.llm.queries import op11_nearest_neighbours


def product(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += float(x) * float(y)
    return total


def brute(rows, k, every):
    """Exact answers: {query: [(id, score)]}."""
    out = {}
    for i, q in rows:
        if i % every == 0:
            others = sorted(((-product(q, v), j) for j, v in rows if j != i))
            out[i] = [(j, -s) for s, j in others[:k]]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v], "x") for i, v in rows], "vec_id long, embedding array<float>, node string")


def recall(got, want):
    assert got.keys() == want.keys()
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    return hit / sum(map(len, want.values()))


@pytest.mark.parametrize("kind,block", [("random", 8192), ("random", 100), ("clusters", 64), ("lengths", 128)])
def test_recall_against_brute_force(spark, kind, block):
    r = np.random.default_rng(3)
    x = r.standard_normal((1500, 24))
    if kind == "clusters":
        x = x[r.integers(0, 30, 1500)] + 0.2 * r.standard_normal((1500, 24))
    if kind != "lengths":
        x /= np.linalg.norm(x, axis=1)[:, None]
    else:
        x *= r.uniform(0.2, 3.0, (1500, 1))
    rows = list(enumerate(x.astype(np.float32).tolist()))
    got = answers(N.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, block=block))
    want = brute(rows, 20, 20)
    assert recall(got, want) >= 0.9
    vectors = dict(rows)
    for q, found in got.items():
        assert len(found) == 20
        assert found == sorted(((i, product(vectors[q], vectors[i])) for i, _ in found), key=lambda x: (-x[1], x[0]))


def test_a_large_group_of_equal_and_of_nearly_equal_vectors(spark):
    r = np.random.default_rng(4)
    base = r.standard_normal(16)
    rows = [(i, base.tolist()) for i in range(300)]
    rows += [(1000 + i, (base + 1e-3 * r.standard_normal(16)).tolist()) for i in range(400)]
    rows += [(2000 + i, r.standard_normal(16).tolist()) for i in range(200)]
    rows = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    got = answers(N.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, block=50))
    want = brute(rows, 20, 20)
    assert recall(got, want) >= 0.9
    one, other = got[20], got[40]  # equal queries differ in their own row only
    assert [x for x in one if x[0] not in (20, 40)][:19] == [x for x in other if x[0] not in (20, 40)][:19]


def test_small_tables_ties_and_unusable_vectors(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, [1.0, 0.0], "x"), (20, [0.0, 1.0], "x"), (1, [1.0, 0.0], "x"), (2, [1.0, 0.0], None), (3, [-1.0, 0.0], "x"),
            (4, None, "x"), (5, [0.0, 0.0], "x"), (6, [nan, 1.0], "x"), (7, [inf, 1.0], "x"), (8, [None, 1.0], "x"),
            (9, [], "x"), (10, [1.0, 2.0, 3.0], "x"), (None, [1.0, 0.0], "x"), (40, None, "x"), (60, [0.0, 0.0], "x"),
            (1, [1.0, 0.0], "x"), (11, [0.0, 2.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, codes string")
    got = answers(N.nearest(df, F.col("vec_id") % 20 == 0, k=3))
    assert got == {0: [(1, 1.0), (2, 1.0), (11, 0.0)], 20: [(11, 2.0), (0, 0.0), (1, 0.0)]}
    assert N.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert answers(N.nearest(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0)) == {}


def test_many_equal_products(spark):
    eye = [(i, [1.0 if j == i % 8 else 0.0 for j in range(8)]) for i in range(400)]
    scaled = [(i, [x * (1 + i // 8 % 3) for x in v]) for i, v in eye]
    got = answers(N.nearest(frame(spark, scaled), F.col("vec_id") % 20 == 0, block=64))
    assert got == brute(scaled, 20, 20)


def test_query_reaches_the_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert recall(answers(op11_nearest_neighbours(spark, sf)), brute(rows, 20, 20)) >= 0.9

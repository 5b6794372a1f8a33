"""Vector searches against brute force, planted hot groups, and edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import ball_tree, cross_polytope
from tabloom.llm.queries import QUERIES

ASKS = "vec_id % 20 = 0"


def table(spark, rows):
    return spark.createDataFrame([(i, x, 1, "q", 2.0) for i, x in rows], "vec_id long, embedding array<float>, rank int, query_id string, score double")


def clustered(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[: n // 3] = x[0] + 0.05 * rng.normal(size=(n // 3, dim))  # a third of the rows around one point
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x.astype(np.float32)


def brute(ids, x, top=20, own=lambda i: i % 20 == 0):
    out = {}
    for i in ids:
        if own(i):
            score = x[ids.index(i)] @ x.T
            order = sorted((j for j in range(len(ids)) if ids[j] != i), key=lambda j: (-score[j], ids[j]))[:top]
            out[i] = [(ids[j], score[j]) for j in order]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("dim,shard,block", [(64, 8192, 2048), (16, 100, 7), (3, 64, 1000)])
def test_top_products_are_exact(spark, dim, shard, block):
    x = clustered(700, dim)
    x[50:60] = x[40]  # ties
    ids = [int(i) for i in np.random.default_rng(2).permutation(3000)[:700]]
    got = found(ball_tree.top_products(table(spark, zip(ids, x.tolist())), F.expr(ASKS), shard=shard, query_block=block))
    assert got == brute(ids, np.floor(64 * x.astype(np.float64)).astype(np.int64))


def test_ball_tree_bounds_and_pruning():
    x = np.floor(64 * clustered(2000, 8).astype(np.float64))
    tree = ball_tree.BallTree(x)
    assert sorted(np.concatenate(tree.leaves)) == list(range(2000))
    upper = tree.bounds(x[:50])
    for i, leaf in enumerate(tree.leaves):
        assert (x[:50] @ x[leaf].T <= upper[:, i][:, None]).all()


def test_top_products_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, None]), (2, [nan, 1.0]), (3, [inf, 0.0]), (4, None), (None, [9.0, 9.0]), (5, [0.0, 0.0]), (6, [-0.001, 0.0]),
            (7, [3.0, 3.0]), (7, [3.0, 3.0]), (8, [1.0]), (20, [1.0, 2.0]), (40, []), (60, [1.0, 2.0, 3.0])]
    got = found(ball_tree.top_products(table(spark, rows), F.expr(ASKS)))
    assert got == {0: [(7, 36864), (20, 20480), (5, 0), (6, -64)], 20: [(7, 36864), (0, 20480), (5, 0), (6, -64)]}
    assert ball_tree.top_products(table(spark, []), F.expr(ASKS)).count() == 0
    assert ball_tree.top_products(table(spark, [(1, [1.0])]), F.expr(ASKS)).count() == 0
    huge = found(ball_tree.top_products(table(spark, [(0, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [2.0**20, 1.0]), (3, [-1e30, 0.0])]), F.expr(ASKS)))
    assert [v for v, _ in huge[0]] == [1, 2, 3] and huge[0][0][1] == 2**63 - 1 and huge[0][2][1] == -(2**63)
    middle = found(ball_tree.top_products(table(spark, [(0, [2.0**20, 3.0]), (1, [2.0**20, 1.0]), (2, [2.0**20, 2.0])]), F.expr(ASKS)))
    assert middle[0] == [(2, 2**52 + 64 * 64 * 6), (1, 2**52 + 64 * 64 * 3)]


def test_neighbours_reach_the_recall(spark, small):
    for folder in (small, small.replace("0.001", "0.01")):
        rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
        ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows])
        want, got = brute(ids, x), found(QUERIES["op1_cross_polytope"](spark, folder))
        assert set(got) == set(want)
        hits = [len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / len(want[q]) for q in want]
        assert np.mean(hits) >= 0.9
        for q in got:
            exact = dict(zip(ids, x[ids.index(q)] @ x.T))
            assert all(abs(s - exact[v]) < 1e-12 for v, s in got[q])


@pytest.mark.parametrize("dim,block", [(64, 4096), (48, 60)])
def test_neighbours_in_a_hot_bucket(spark, dim, block):
    """A third of the rows share their buckets: split into blocks they give the same answer."""
    x = clustered(900, dim).astype(np.float64)
    got = found(cross_polytope.nearest(table(spark, zip(range(900), x.tolist())), F.expr(ASKS), block=block))
    want = brute(list(range(900)), np.array(x, np.float32).astype(np.float64))
    hits = [len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9


def test_two_hashes_make_squared_buckets_and_probes_come_by_nearness():
    x = clustered(300, 64).astype(np.float64)
    own = cross_polytope.probes(x, 0, 2, 1)
    looks = cross_polytope.probes(x, 0, 2, 40)
    assert (looks[:, 0] == own[:, 0]).all() and len(np.unique(own)) > 128
    assert all(len(set(row)) == 40 for row in looks.tolist())
    turned = cross_polytope.turned(x, 3)
    assert np.allclose((turned**2).sum(1), (x**2).sum(1))


def test_neighbour_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0, 0.0]), (1, [1.0, None, 1.0]), (2, [nan, 1.0, 1.0]), (3, [inf, 0.0, 1.0]), (4, None), (None, [9.0, 9.0, 9.0]), (5, [0.0, 0.0, 0.0]),
            (6, [1e-30, 0.0, 0.0]), (7, [3.0, 3.0, 1.0]), (7, [3.0, 3.0, 1.0]), (8, [1.0]), (20, [1.0, 2.0, 0.0]), (40, [0.0]), (60, [])]
    got = found(cross_polytope.nearest(table(spark, rows), F.expr(ASKS)))
    assert [v for v, _ in got[0]] == [7, 20, 6] and got[0][0][1] == 9.0 and 40 not in got and 60 not in got
    assert cross_polytope.nearest(table(spark, []), F.expr(ASKS)).count() == 0
    assert cross_polytope.nearest(table(spark, [(0, [1.0])]), F.expr(ASKS)).count() == 0

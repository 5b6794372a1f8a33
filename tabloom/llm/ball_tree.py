"""Exact top-k inner products: branch and bound over ball trees, one tree per shard.

Vectors are dealt into shards of bounded size, queries into blocks. A task builds the tree of its shard and takes each
query to the leaves in the order of their upper bound q.c + |q| r, until the bound falls under the query's kth score.
Every query visits one shard first; the kth score it has there goes with it to all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import groups, kept, on_executors
from tabloom.llm.search import TOP, block_pairs, grouped, kth_scores, matrix, ranked, vectors

SHARD = 8192
QUERY_BLOCK = 2048
LEAF = 64
_NONE = np.iinfo(np.int64).min


class BallTree:
    """Nodes level by level; each halves its points along the axis of largest spread."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        centres, radii, parents, self.leaves, self.leaf_node = [], [], [], [], []
        level = [(np.arange(len(points)), -1)]
        while level:
            below = []
            for at, parent in level:
                own = points[at]
                centre = own.mean(axis=0)
                node = len(centres)
                centres.append(centre)
                radii.append(np.sqrt(((own - centre) ** 2).sum(axis=1).max()))
                parents.append(parent)
                spread = own.max(axis=0) - own.min(axis=0) if own.shape[1] else np.zeros(1)
                if len(at) <= leaf or spread.max() == 0:
                    self.leaves.extend(np.sort(at[s:s + leaf]) for s in range(0, len(at), leaf))
                    self.leaf_node.extend([node] * -(-len(at) // leaf))
                else:
                    order = np.argpartition(own[:, spread.argmax()], len(at) // 2)
                    below += [(at[order[: len(at) // 2]], node), (at[order[len(at) // 2:]], node)]
            level = below
        self.centres, self.radii, self.parents = np.array(centres), np.array(radii), np.array(parents)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """(queries, leaves): no inner product with a point of the leaf is larger."""
        norms = np.sqrt((queries**2).sum(axis=1))
        upper = queries @ self.centres.T + norms[:, None] * self.radii
        upper += 1e-9 * (np.abs(upper) + norms[:, None] * np.abs(self.centres).max(initial=0.0) + 1.0)
        for node, parent in enumerate(self.parents):
            if parent >= 0:
                np.minimum(upper[:, node], upper[:, parent], out=upper[:, node])
        return upper[:, self.leaf_node]

    def search(self, queries: np.ndarray, skip: np.ndarray, bound: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and places of the best points for each query, best first, ties to the smaller place; -1 is none.

        ``skip`` is the place of a point that a query must not find, or -1; ``bound`` is the score a result must reach.
        Components are whole numbers.
        """
        n, width = len(self.points), max(map(len, self.leaves))
        upper = self.bounds(queries)
        order = np.argsort(-upper, axis=1, kind="stable")
        best = np.full((len(queries), top), _NONE)  # score and place in one number: score * n + (n - 1 - place)
        padded = np.full((len(self.leaves), width), -1)
        for i, leaf in enumerate(self.leaves):
            padded[i, : len(leaf)] = leaf
        active = np.arange(len(queries))
        for turn in range(len(self.leaves)):
            leaf_of = order[active, turn]
            kth = best[active].min(axis=1)
            floor = np.maximum(np.where(kth == _NONE, -np.inf, np.floor_divide(kth, n)), bound[active])
            open_ = upper[active, leaf_of] >= floor
            active, leaf_of = active[open_], leaf_of[open_]
            if len(active) == 0:
                break
            fresh = np.full((len(active), width), _NONE)
            for leaf in np.unique(leaf_of):
                here, places = np.flatnonzero(leaf_of == leaf), self.leaves[leaf]
                score = np.rint(queries[active[here]] @ self.points[places].T).astype(np.int64)
                coded = score * n + (n - 1 - places)
                coded[(score < bound[active[here]][:, None]) | (places == skip[active[here]][:, None])] = _NONE
                fresh[here[:, None], np.arange(len(places))] = coded
            merged = np.concatenate([best[active], fresh], axis=1)
            best[active] = np.partition(merged, merged.shape[1] - top, axis=1)[:, -top:]
        best = -np.sort(-best, axis=1)
        return np.floor_divide(best, n), np.where(best == _NONE, -1, n - 1 - np.mod(best, n))


def _plain(points: np.ndarray, queries: np.ndarray, skip: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The same by whole Python numbers, for products that leave no room for the place beside them."""
    scores, places = np.zeros((len(queries), top), np.int64), np.full((len(queries), top), -1)
    whole = [[int(v) for v in p] for p in points]
    for i, query in enumerate([[int(v) for v in q] for q in queries]):
        exact = [sum(a * b for a, b in zip(query, p)) for p in whole]
        order = sorted((j for j in range(len(whole)) if j != skip[i]), key=lambda j: (-exact[j], j))[:top]
        scores[i, : len(order)] = [max(min(exact[j], (1 << 63) - 1), -(1 << 63)) for j in order]
        places[i, : len(order)] = order
    return scores, places


def _search(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in groups(batches, ["dim", "block", "query_block"]):
            for s, e in zip(starts[:-1], starts[1:]):
                part = table.slice(int(s), int(e - s))
                asks, ids = part.column("asks").to_numpy(), part.column("vec_id").to_numpy()
                n = int((~asks).sum())
                x = matrix(part.column("x"), part.column("dim")[0].as_py())
                if n == 0 or n == len(ids):
                    continue
                bound = np.nan_to_num(part.column("bound").to_numpy()[n:].astype(np.float64), nan=-np.inf, neginf=-np.inf)
                at = np.searchsorted(ids[:n], ids[n:])
                skip = np.where(ids[:n][np.minimum(at, n - 1)] == ids[n:], at, -1)
                if (np.abs(x[:n]).max(initial=0) * np.abs(x[n:]).max(initial=0) * max(1, x.shape[1])) * n < 2.0**52:
                    scores, places = BallTree(x[:n]).search(x[n:], skip, bound, top)
                else:
                    scores, places = _plain(x[:n], x[n:], skip, top)
                query, rank = np.nonzero(places >= 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[n:][query]), pa.array(ids[:n][places[query, rank]]), pa.array(scores[query, rank])], ["query_id", "vec_id", "score"],
                )

    return run


def top_products(table: DataFrame, is_query, top: int = TOP, scale: float = 64.0, shard: int = SHARD, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` largest inner products of floor(scale * x), ties to smaller vec_id.

    Queries are the rows where ``is_query`` holds; candidates are all rows but the query's own. Null ids and vectors
    that are null or hold null or non-finite components take no part; rows sharing a vec_id count once, with the
    smallest vector; vectors of other lengths are not compared. A query with fewer candidates gets all of them.
    Scores beyond a long are held at its ends. Without queries or candidates there are no rows.
    """
    rows = vectors(table, is_query, scale=lambda c: F.floor(c * F.lit(scale)).cast("double"))
    asking = rows.where("is_query").select("vec_id", "dim", "x")
    members = rows.select("vec_id", "dim", "x")

    def searched(queries: DataFrame, which) -> DataFrame:
        pairs = block_pairs(members, queries, ["dim"], shard, query_block).where(which)
        return kept(on_executors(grouped(pairs.drop("n_blocks"), ["dim"]), _search(top), "query_id bigint, vec_id bigint, score bigint"), "found")

    home = F.col("block") == F.col("query_block") % F.col("n_blocks")
    first = searched(asking.withColumn("bound", F.lit(None).cast("double")), home)
    rest = searched(asking.join(kth_scores(first, top), "vec_id", "left"), ~home)
    return ranked(first.unionByName(rest), top)


SQL = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64.0::DOUBLE * x::DOUBLE)) AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

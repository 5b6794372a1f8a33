"""Approximate nearest neighbours by cross-polytope hashing.

A hash turns a unit vector by three rounds of random signs and a fast Hadamard transform, and takes the nearest of the
signed axes. Each table has its own turns. A query looks into the buckets of its ``PROBES`` nearest axes in every table;
the candidates found there are ranked by the exact inner product of the original vectors.

The bucket of the nearest axis gives every query a kth score that results of the other probes must reach, so few
candidates leave a task. A bucket may hold any number of vectors: it is dealt out in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import groups, kept, on_executors
from tabloom.llm.search import TOP, block_pairs, grouped, kth_scores, matrix, ranked, vectors

TABLES = 8
PROBES = 20
BLOCK = 4096
ROUNDS = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the Hadamard matrix of their length, a power of two; orthogonal."""
    n, half = x.shape[1], 1
    while half < n:
        pairs = x.reshape(len(x), -1, 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        half *= 2
    return x / np.sqrt(n)


def turned(x: np.ndarray, table: int, hash_: int = 0, seed: int = 5) -> np.ndarray:
    """Unit rows after the pseudo-rotation of one hash; padded with zeros to a power of two."""
    size = 1 << max(0, x.shape[1] - 1).bit_length()
    x = np.pad(x, ((0, 0), (0, size - x.shape[1])))
    rng = np.random.default_rng((seed, table, hash_))
    for _ in range(ROUNDS):
        x = hadamard(x * rng.choice([-1.0, 1.0], size))
    return x


def probes(x: np.ndarray, table: int, hashes: int, count: int) -> np.ndarray:
    """(rows, count): buckets by nearness, those of the vector itself first; -1 where there are no more buckets.

    With one hash a bucket is a signed axis; with more it is one for each hash, nearest by the sum of the products.
    """
    turns = [turned(x, table, h) for h in range(hashes)]
    axes = [np.concatenate([t, -t], axis=1) for t in turns]
    size = axes[0].shape[1]
    each = min(size, count)
    near = [np.argsort(-a, axis=1, kind="stable")[:, :each] for a in axes]
    if hashes == 1:
        codes = near[0]
    else:
        worth = [np.take_along_axis(a, n, axis=1) for a, n in zip(axes, near)]
        choices = [c for c in product(range(each), repeat=hashes) if np.prod(np.add(c, 1)) <= count]  # no other can be among the first
        code = np.stack([sum(near[h][:, c[h]].astype(np.int64) * size**h for h in range(hashes)) for c in choices], axis=1)
        total = np.stack([sum(worth[h][:, c[h]] for h in range(hashes)) for c in choices], axis=1)
        codes = np.take_along_axis(code, np.argsort(-total, axis=1, kind="stable")[:, :count], axis=1)
    out = np.full((len(x), count), -1, np.int64)
    out[:, : codes.shape[1]] = codes
    return out


def _addressed(rows: DataFrame, tables: int, hashes: int, count: int) -> DataFrame:
    """``rows`` with table, probe and bucket: a row for each bucket that a vector lies in or looks into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x = matrix(pa.chunked_array([part.column("x")]), int(dim))
                unit = x / np.abs(x).max(axis=1, keepdims=True)  # first by the largest component: squares neither vanish nor overflow
                unit = unit / np.sqrt((unit**2).sum(axis=1, keepdims=True))
                for t in range(tables):
                    buckets = probes(unit, t, hashes, count)
                    for p in range(count):
                        looks = buckets[:, p] >= 0
                        here = part.filter(pa.array(looks)) if not looks.all() else part
                        size = here.num_rows
                        yield pa.RecordBatch.from_arrays(
                            [*here.columns, pa.array(np.full(size, t, np.int32)), pa.array(np.full(size, p, np.int32)), pa.array(buckets[looks, p])],
                            [*here.schema.names, "table", "probe", "bucket"],
                        )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return on_executors(rows, run, f"{kinds}, table int, probe int, bucket bigint")


def _rerank(top: int):
    """The best ``top`` candidates of each query in each pair of blocks, if they reach the query's bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in groups(batches, ["dim", "table", "bucket", "block", "query_block"]):
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for s, e in zip(starts[:-1], starts[1:]):
                part = table.slice(int(s), int(e - s))
                asks, ids = part.column("asks").to_numpy(), part.column("vec_id").to_numpy()
                n = int((~asks).sum())
                if n == 0 or n == len(ids):
                    continue
                x = matrix(part.column("x"), part.column("dim")[0].as_py())
                bound = np.nan_to_num(part.column("bound").to_numpy()[n:].astype(np.float64), nan=-np.inf, neginf=-np.inf)
                for q in range(n, len(ids), 256):
                    mine = ids[q:q + 256]
                    score = x[q:q + 256] @ x[:n].T
                    score[mine[:, None] == ids[None, :n]] = np.nan
                    score[score < bound[q - n:q - n + 256, None]] = np.nan
                    order = np.argsort(-score, axis=1, kind="stable")[:, :top]  # members come by vec_id; NaN goes last
                    best = np.take_along_axis(score, order, axis=1)
                    row, col = np.nonzero(~np.isnan(best))
                    out.append((mine[row], ids[order[row, col]], best[row, col]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query_id", "vec_id", "score"])

    return run


def nearest(table: DataFrame, is_query, top: int = TOP, tables: int = TABLES, count: int = PROBES, hashes: int = 1, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` largest inner products found for each query, ties to smaller vec_id.

    Queries are the rows where ``is_query`` holds; candidates are all rows but the query's own. Null ids and vectors
    that are null, zero or hold null or non-finite components take no part; rows sharing a vec_id count once, with the
    smallest vector; vectors of other lengths are not compared. One hash makes 2 * dimension buckets a table; for more
    than some million vectors take ``hashes=2``, which squares them. Without queries or candidates there are no rows.
    """
    rows = vectors(table, is_query).where(F.exists("x", lambda c: c != 0))
    keys = ["dim", "table", "bucket"]
    members = _addressed(rows.select("vec_id", "dim", "x"), tables, hashes, 1).drop("probe")
    looks = _addressed(rows.where("is_query").select("vec_id", "dim", "x"), tables, hashes, count)

    def searched(queries: DataFrame) -> DataFrame:
        pairs = grouped(block_pairs(members, queries, keys, block, block).drop("n_blocks"), keys)
        return kept(on_executors(pairs, _rerank(top), "query_id bigint, vec_id bigint, score double"), "found")

    first = searched(looks.where("probe = 0").drop("probe").withColumn("bound", F.lit(None).cast("double")))
    rest = searched(looks.where("probe > 0").drop("probe").join(kth_scores(first, top), "vec_id", "left"))
    return ranked(first.unionByName(rest), top)

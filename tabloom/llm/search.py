"""What vector searches share: which rows take part, pairs of blocks of vectors and queries, the final ranks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import kept

TOP = 20


def vectors(table: DataFrame, is_query: Column, embedding: str = "embedding", vec_id: str = "vec_id", scale: Callable[[Column], Column] | None = None) -> DataFrame:
    """(vec_id, is_query, dim, x: array<double>) of the rows that take part, one for each vec_id; kept in the shared folder.

    Null ids and vectors that are null or hold null or non-finite components take no part. Of rows with the same vec_id
    the one with the smallest vector counts. ``scale`` is applied to every component as a double.
    """
    x = F.transform(F.col(embedding), lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    some = table.select(F.col(vec_id).cast("bigint").alias("vec_id"), is_query.alias("is_query"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & fine,
    )
    one = some.groupBy("vec_id").agg(F.max("is_query").alias("is_query"), F.min("x").alias("x"))
    scaled = F.transform("x", scale) if scale else F.col("x")
    return kept(one.select("vec_id", F.coalesce("is_query", F.lit(False)).alias("is_query"), F.size("x").alias("dim"), scaled.alias("x")), "vectors")


def block_pairs(members: DataFrame, queries: DataFrame, keys: Sequence[str], member_block: int, query_block: int) -> DataFrame:
    """Members and queries with the same ``keys``, side by side: every block of members with every block of queries.

    Blocks hold about ``member_block`` members and ``query_block`` queries, drawn by a hash of the id, so neither a full
    key nor many queries make a large group. Adds ``n_blocks`` (blocks of members), ``block``, ``query_block`` and
    ``asks`` (false for members). Keys without a member or without a query are dropped.
    """
    both = members.withColumn("asks", F.lit(False)).unionByName(queries.withColumn("asks", F.lit(True)), allowMissingColumns=True)
    sizes = both.groupBy(*keys).agg(
        F.ceil(F.sum((~F.col("asks")).cast("int")) / member_block).cast("int").alias("n_blocks"),
        F.ceil(F.sum(F.col("asks").cast("int")) / query_block).cast("int").alias("_n_query_blocks"),
    )
    sizes = kept(sizes.where("n_blocks > 0 AND _n_query_blocks > 0"), "block-sizes")
    own = F.pmod(F.xxhash64("vec_id"), F.when(F.col("asks"), F.col("_n_query_blocks")).otherwise(F.col("n_blocks"))).cast("int")
    other = F.sequence(F.lit(0), F.when(F.col("asks"), F.col("n_blocks")).otherwise(F.col("_n_query_blocks")) - 1)
    dealt = both.join(sizes, list(keys)).withColumn("_own", own).withColumn("_other", F.explode(other))
    return dealt.withColumn("block", F.when(F.col("asks"), F.col("_other")).otherwise(F.col("_own"))).withColumn(
        "query_block", F.when(F.col("asks"), F.col("_own")).otherwise(F.col("_other")),
    ).drop("_own", "_other", "_n_query_blocks")


def grouped(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each pair of blocks in one task, members first, by vec_id."""
    return pairs.repartition(*keys, "block", "query_block").sortWithinPartitions(*keys, "block", "query_block", "asks", "vec_id")


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): the best ``top`` of each query, ties to the smaller vec_id."""
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def kth_scores(found: DataFrame, top: int = TOP) -> DataFrame:
    """(vec_id, bound) of the queries that have ``top`` results: a later result must reach this score to count."""
    return ranked(found, top).where(F.col("rank") == top).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("bound"))

"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import kept


def _nearest(links: DataFrame, rows: int) -> DataFrame:
    """(node, least): the smallest neighbour of each node or the node itself. Kept, so that a join with it can split hot nodes."""
    return kept(links.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("least")), "nearest", rows)


def _is_done(links: DataFrame) -> bool:
    """Whether each component is a star: every node has one link, to a node that has none itself."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(links.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 AND up > 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node in ``links`` (a, b: long): component is the smallest node it can reach.

    Each round links every node to the smallest node near it, first for larger, then for smaller neighbours; the number
    of rounds grows with the logarithm of the longest chain. Links with a null end are left out; a link of a node to
    itself gives a component of one. ``links`` is read several times. How many rows the tables of
    a round have at most is known from the round before; small ones are not written as a file per shuffle partition.
    """
    clean = links.where("a IS NOT NULL AND b IS NOT NULL").select(F.col("a").cast("bigint"), F.col("b").cast("bigint"))
    alone = clean.where("a = b").select("a")
    now = clean.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    rows = now.count()
    while rows:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        larger = both.where("b > a").join(_nearest(both, 2 * rows), F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = kept(larger.where("a <> b").distinct(), "large-star", rows)
        joined = large.join(_nearest(large, rows), F.col("a") == F.col("node"))
        small = joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b")).where("a <> b")
        now = kept(small.distinct(), "small-star", 2 * rows)
        if _is_done(now):
            break
        rows = now.count()
    every = now.unionAll(now.select("b", F.col("b").alias("_b"))).unionAll(alone.select("a", F.col("a").alias("_a")))
    return every.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))

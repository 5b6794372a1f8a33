"""Registry, table access and the inputs several queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` computes the same rows in plain SQL."""

    def add(function):
        if name in QUERIES:
            raise ValueError(f"query {name} exists already")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _off_ties(digits: int) -> float:
    """A shift far below the rounding step: decimal data has exact ties, which a last bit would decide."""
    return float(f"3.7e-{digits + 3}")


def rnd(c: Column | str, digits: int = 4) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c) + F.lit(_off_ties(digits)), digits)


def sql_rnd(expression: str, digits: int = 4) -> str:
    """The same in SQL, with negative zero turned into zero."""
    return f"(round(({expression}) + {_off_ties(digits)!r}::DOUBLE, {digits}) + 0.0::DOUBLE)"


def sql_hash(key: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {key}::VARCHAR, '{seed}')), 1, 7))::BIGINT"


# orders with missing numbers and categories

def gappy_orders(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(key % 17 != 0, F.col("o_totalprice")).alias("x"),
        F.when(key % 23 != 0, F.col("o_orderpriority")).alias("g"),
        F.col("o_custkey").alias("c"),
        F.col("o_orderstatus").alias("s"),
    )


GAPPY = """gappy AS (
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS x,
           CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderpriority END AS g,
           o_custkey AS c, o_orderstatus AS s
    FROM orders)"""


# predictions without a model

def predictions(spark: SparkSession, folder: str) -> DataFrame:
    key, y = F.col("o_orderkey"), F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        key, y.alias("y"), (y * 0.9 + key % 101).alias("m1"), (y * 1.1 - key % 53).alias("m2"),
        F.col("o_orderpriority").alias("grp"),
    )


PREDICTIONS = """pred AS (
    SELECT o_orderkey, o_totalprice AS y, o_totalprice * 0.9 + o_orderkey % 101 AS m1,
           o_totalprice * 1.1 - o_orderkey % 53 AS m2, o_orderpriority AS grp
    FROM orders)"""


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """Binary label and a score with many ties."""
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        key, (key % 3 == 0).cast("int").alias("y"), ((key % 97) / 97.0).alias("p"),
        (((key % 97) / 97.0) > 0.5).cast("int").alias("guess"),
    )


SCORES = """scores AS (
    SELECT o_orderkey, CAST(o_orderkey % 3 = 0 AS INT) AS y, (o_orderkey % 97) / 97.0 AS p,
           CAST((o_orderkey % 97) / 97.0 > 0.5 AS INT) AS guess
    FROM orders)"""


def classes(spark: SparkSession, folder: str) -> DataFrame:
    """Three classes, a guess, and an array of class probabilities that adds up to 1."""
    key = F.col("o_orderkey")
    a, b = (key % 31 + 1) / 100.0, (key % 17 + 1) / 50.0
    return table(spark, folder, "orders").select(
        key, (key % 7 % 3).cast("int").alias("y"), (key % 5 % 3).cast("int").alias("guess"),
        F.array(*[F.round(v, 9) for v in (a, b, 1 - a - b)]).alias("p"),
    )


CLASSES = """classes AS (
    SELECT o_orderkey, CAST(o_orderkey % 7 % 3 AS INT) AS y, CAST(o_orderkey % 5 % 3 AS INT) AS guess,
           round((o_orderkey % 31 + 1) / 100.0, 9) AS p0, round((o_orderkey % 17 + 1) / 50.0, 9) AS p1,
           round(1 - (o_orderkey % 31 + 1) / 100.0 - (o_orderkey % 17 + 1) / 50.0, 9) AS p2
    FROM orders)"""


# fit on the training part, apply to everything with some categories never seen

VALIDATION = f"({sql_hash('o_orderkey')} % 10000 < 2000)"


def unseen(df: DataFrame, column: str = "g") -> DataFrame:
    return df.withColumn(column, F.when(F.col("o_orderkey") % 29 == 0, "UNSEEN").otherwise(F.col(column)))


def sql_unseen(column: str = "g") -> str:
    return f"CASE WHEN o_orderkey % 29 = 0 THEN 'UNSEEN' ELSE {column} END"

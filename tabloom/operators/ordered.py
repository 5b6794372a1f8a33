"""Ordered target statistics: a category's mean label over the rows before, along a random order of the rows.

No row sees its own label, so a model can be fitted on the encoded rows themselves. New rows take the mean of all
fitted ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.hashing import HASH_RANGE, hash28
from tabloom.operators.base import Fitted, Step
from tabloom.operators.categories import MISSING, CategoryTable
from tabloom.operators.stats import RANGE_ROWS, quoted, value


def ordered_means(
    df: DataFrame, columns: Sequence[str], label: str, key: str, prior: float, weight: float = 1.0, seed: int = 42,
    prefix: str = "", suffix: str = "_ordered", range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``(sum of earlier labels + weight * prior) / (earlier labels + weight)`` of the row's category, for each column.

    The order is a hash of the row key, then the key itself, which must be unique. NULL is the category 'missing'; a
    NULL label counts for nobody. The hash cuts the order into ranges: a category with any share of the rows is spread
    over tasks, each sums up its range, and the totals of earlier ranges (a row per category and range) are added.
    """
    ranges = min(1 << 16, 1 << (df.count() // range_rows).bit_length())
    order = hash28(key, seed=seed)
    held = df.withColumn("__order", order).withColumn("__y", value(df, label).cast("double"))
    held = held.withColumn("__range", F.floor(F.col("__order") / F.lit(HASH_RANGE // ranges)).cast("int"))
    for c in columns:
        keyed = held.withColumn("__category", F.coalesce(quoted(c), F.lit(MISSING)))
        inside = Window.partitionBy("__category", "__range").orderBy("__order", quoted(key)).rowsBetween(Window.unboundedPreceding, -1)
        s, n = F.coalesce(F.sum("__y").over(inside), F.lit(0.0)), F.count("__y").over(inside)
        if ranges > 1:
            totals = keyed.groupBy("__category", "__range").agg(F.sum("__y").alias("__s"), F.count("__y").alias("__n"))
            before = Window.partitionBy("__category").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
            earlier = totals.select(
                "__category", "__range", F.coalesce(F.sum("__s").over(before), F.lit(0.0)).alias("__before_s"),
                F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before_n"),
            )
            keyed = keyed.withColumn("__inside_s", s).withColumn("__inside_n", n).join(earlier, ["__category", "__range"])
            s, n = F.col("__inside_s") + F.col("__before_s"), F.col("__inside_n") + F.col("__before_n")
        mean = (s + F.lit(float(weight * prior))) / (n + F.lit(float(weight)))
        held = keyed.withColumn(f"{prefix}{c}{suffix}", mean).drop("__category", "__inside_s", "__inside_n", "__before_s", "__before_n")
    return held.drop("__order", "__range", "__y")


class OrderedTargetEncoder(Step):
    """Replaces categories by label means: ``encode_fitted`` on the rows of the fit (ordered), ``transform`` on others."""

    defaults = {"weight": 1.0, "seed": 42, "max_local": 20_000}

    def _fit(self, df: DataFrame) -> "OrderedTargetModel":
        label, columns, weight = self.opt("label"), self.strings(df), float(self.opt("weight"))
        if not label or not self.opt("key"):
            raise ValueError("ordered target statistics need a label and a row key")
        target = value(df, label).cast("double")
        prior = df.agg(F.avg(target)).first()[0] or 0.0
        mean = (F.coalesce(F.sum(target), F.lit(0.0)) + F.lit(weight * prior)) / (F.count(target) + F.lit(weight))
        table = CategoryTable.build(df, columns, {"mean": mean}, max_local=self.opt("max_local"))
        return OrderedTargetModel(table=table, prior=prior, weight=weight, seed=self.opt("seed"), label=label, key=self.opt("key"))


class OrderedTargetModel(Fitted):
    """New rows: the mean of their category over all fitted rows, the overall mean for unknown ones."""

    def encode_fitted(self, df: DataFrame) -> DataFrame:
        """The rows of the fit, each with the means of the rows before it."""
        f = self.fitted
        columns = list(f["table"]["columns"])
        made = ordered_means(df, columns, f["label"], f["key"], f["prior"], f["weight"], f["seed"], prefix="__o_", suffix="")
        return made.select(*[F.col(f"`__o_{c}`").alias(c) if c in columns else quoted(c) for c in df.columns])

    def _transform(self, df: DataFrame) -> DataFrame:
        for c in [c for c in self.fitted["table"]["columns"] if c in df.columns]:
            order = df.columns
            coded = CategoryTable.join(df, self.fitted["table"], c, {"mean": "double"}, {"mean": "__mean"}, {"mean": self.fitted["prior"]})
            df = coded.select(*[F.col("__mean").alias(o) if o == c else quoted(o) for o in order])
        return df

"""Categorical encoding."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.base import Fitted, Step, append_columns, present
from tabloom.operators.categories import MISSING, CategoryTable
from tabloom.operators.lookup import lookup_join
from tabloom.operators.split import fold_of
from tabloom.operators.stats import quoted, value


NULL = "\uffff"  # stands for NULL where that is apart from every text; sorts last


class CategoricalEncoder(Step):
    """Encode string columns; all columns are fitted by one grouped aggregate.

    ``label``: 0-based code in sorted order, missing is the category ``'missing'``, unknown gives
    ``unknown_value``. ``onehot``: one 0/1 column per category, the source column goes; NULL is a
    category of its own, ``<column>_nan``, apart from the text ``'missing'``. More categories than
    ``max_columns``, or than the model can hold itself (``max_local``), become one sparse vector column
    ``<column>_onehot`` instead. ``target``: mean
    label per category; NULL and unknown take the mean of rows with the text ``'missing'``, or 0.
    """

    defaults = {
        "method": "label", "handle_unknown": "use_encoded_value", "unknown_value": -1, "max_columns": None,
        "max_local": 20_000,
    }

    def _fit(self, df: DataFrame) -> "Fitted":
        method, columns = self.opt("method"), self.strings(df)
        size = self.opt("max_local")
        if method == "label":
            table = CategoryTable.build(df, columns, {}, codes=True, max_local=size)
            return LabelEncoderModel(table=table, unknown=self.opt("unknown_value"))
        if method == "onehot":
            table = CategoryTable.build(df, columns, {}, codes=True, max_local=size, null_as=NULL)
            return OneHotEncoderModel(table=table, max_columns=self.opt("max_columns"))
        if method == "target":
            label = self.opt("label")
            if not label:
                raise ValueError("target encoding needs a label column")
            table = CategoryTable.build(
                df, columns, {"mean": F.avg(value(df, label).cast("double"))}, max_local=size, null_as=None
            )
            overall = {c: _missing_mean(df.sparkSession, table, c) for c in columns}
            return TargetEncoderModel(table=table, unknown=overall)
        raise ValueError(f"unknown encoding method: {method}")


def _missing_mean(spark, table: dict, column: str) -> float:
    known, _, _ = CategoryTable.table(spark, table, column, {"mean": "double"})
    row = known.filter(F.col("category") == MISSING).select("mean").head(1)
    return row[0][0] if row and row[0][0] is not None else 0.0


class LabelEncoderModel(Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        for c in present(df, self.fitted["table"]["columns"]):
            order = df.columns
            coded = CategoryTable.join(
                df, self.fitted["table"], c, {"code": "bigint"}, {"code": "__code"},
                {"code": self.fitted["unknown"]},
            )
            df = coded.select(*[F.col("__code").alias(o) if o == c else quoted(o) for o in order])
        return df


class TargetEncoderModel(Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        for c in present(df, self.fitted["table"]["columns"]):
            order = df.columns
            coded = CategoryTable.join(
                df, self.fitted["table"], c, {"mean": "double"}, {"mean": "__mean"},
                {"mean": self.fitted["unknown"][c]},
            )
            df = coded.select(*[F.col("__mean").alias(o) if o == c else quoted(o) for o in order])
        return df


class OneHotEncoderModel(Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        table = self.fitted["table"]
        for c in present(df, table["columns"]):
            held = table["columns"][c]
            count = len(held["rows"]) if "rows" in held else held["count"]
            most = self.fitted["max_columns"]
            if "rows" not in held or (most is not None and count > most):
                df = _one_hot_vector(df, table, c, count)
                continue
            filled = F.coalesce(quoted(c), F.lit(NULL))
            known = CategoryTable.categories(table, c)
            names = [f"{c}_{'nan' if v == NULL else v}" for v in known]
            if len(set(names)) < len(names):
                names = [f"{c}_{'nan_null' if v == NULL else v}" for v in known]  # the text 'nan' is a category too
            flags = {n: F.when(filled == F.lit(v), 1.0).otherwise(0.0) for n, v in zip(names, known)}
            df = append_columns(df, flags).drop(quoted(c))
        return df


def _one_hot_vector(df: DataFrame, table: dict, column: str, count: int) -> DataFrame:
    marked = df.withColumn(column, F.coalesce(quoted(column), F.lit(NULL)))
    coded = CategoryTable.join(
        marked, table, column, {"code": "bigint"}, {"code": "__code"}, {"code": count}
    ).withColumn("__code", F.col("__code").cast("double"))
    sizes = df.sparkSession.range(count - 1, count).select(F.col("id").cast("double").alias("__code"))
    encoder = OneHotEncoder(
        inputCol="__code", outputCol=f"{column}_onehot", dropLast=True, handleInvalid="keep"
    ).fit(sizes)
    return encoder.transform(coded).drop("__code", column)


def out_of_fold_target(
    df: DataFrame, column: str, label: str, key: str, to: str, folds: int = 5, seed: int = 42, null_as: str | None = None,
) -> DataFrame:
    """Mean label of the row's category over the *other* folds; 0 where no other row has it.

    NULL takes what rows with the text 'missing' in the other folds have; ``null_as`` counts NULL rows in as such.

    One aggregate per (category, fold); a fold's value is the total minus its own share. Joining on
    (category, fold) also spreads a frequent category over the folds.
    """
    folded = df.withColumn("__fold", fold_of(key, folds, seed))
    target = value(df, label).cast("double")
    table = CategoryTable.build(
        folded, [column], {"s": F.sum(target), "n": F.count(target)}, extra_keys=["__fold"], null_as=null_as
    )
    kinds = {"__fold": "int", "s": "double", "n": "bigint"}
    grouped, rows, hot = CategoryTable.table(df.sparkSession, table, column, kinds)
    means = _other_folds(grouped).select(F.col("category").alias("__category"), "__fold", F.col("mean").alias(to))
    keyed = folded.withColumn("__category", F.coalesce(quoted(column), F.lit(MISSING)))
    joined = lookup_join(keyed, means, ["__category", "__fold"], {to: 0.0}, rows=rows, hot=hot)
    return joined.drop("__category", "__fold")


def _other_folds(grouped: DataFrame) -> DataFrame:
    whole = Window.partitionBy("category")  # one row per fold
    others = F.sum("s").over(whole) - F.col("s")
    rows = F.sum("n").over(whole) - F.col("n")
    return grouped.withColumn("mean", F.try_divide(others, rows.cast("double")))

"""Feature steps. Input columns stay, features are appended, the row count never changes."""

from __future__ import annotations

from itertools import combinations, combinations_with_replacement

from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.columns import safe_divide, safe_log, safe_sqrt
from tabloom.operators.base import Fitted, Step, append_columns, present
from tabloom.operators.categories import MISSING, CategoryTable
from tabloom.operators.encode import _missing_mean, out_of_fold_target
from tabloom.operators.stats import datetime_columns, quoted, value


class FeatureStep(Step):
    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


class FeatureModel(Fitted):
    """Features as one projection over the input columns."""

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        raise NotImplementedError

    def _transform(self, df: DataFrame) -> DataFrame:
        return append_columns(df, self.expressions(df))

    def get_feature_names_out(self) -> list[str]:
        return list(self.fitted["names"])


NUMERIC_TRANSFORMS = {
    "log": safe_log,
    "sqrt": safe_sqrt,
    "square": lambda c: c * c,
    "exp": F.exp,
    "abs": F.abs,
}


class NumericFeatures(FeatureStep):
    """``<column>_log``, ``_sqrt``, ``_square`` (also ``_exp``, ``_abs``)."""

    defaults = {"transformations": ["log", "sqrt", "square"]}

    def _fit(self, df: DataFrame) -> "NumericFeaturesModel":
        kinds = self.opt("transformations")
        unknown = set(kinds) - set(NUMERIC_TRANSFORMS)
        if unknown:
            raise ValueError(f"unknown transformations: {sorted(unknown)}")
        columns = self.numeric(df)
        names = [f"{c}_{k}" for c in columns for k in kinds]
        return NumericFeaturesModel(columns=columns, kinds=list(kinds), names=names)


class NumericFeaturesModel(FeatureModel):
    def expressions(self, df: DataFrame) -> dict[str, Column]:
        return {
            f"{c}_{k}": NUMERIC_TRANSFORMS[k](value(df, c).cast("double"))
            for c in present(df, self.fitted["columns"]) for k in self.fitted["kinds"]
        }


class InteractionFeatures(FeatureStep):
    """``<a>_multiply_<b>``, ``_add_``, ``_divide_`` for the first ``max_interactions`` column pairs."""

    defaults = {"max_interactions": 50}

    def _fit(self, df: DataFrame) -> "InteractionFeaturesModel":
        pairs = list(combinations(self.numeric(df), 2))[: self.opt("max_interactions")]
        names = [f"{a}_{op}_{b}" for a, b in pairs for op in ("multiply", "add", "divide")]
        return InteractionFeaturesModel(pairs=[list(p) for p in pairs], names=names)


class InteractionFeaturesModel(FeatureModel):
    def expressions(self, df: DataFrame) -> dict[str, Column]:
        out = {}
        for a, b in self.fitted["pairs"]:
            if a in df.columns and b in df.columns:
                left, right = value(df, a).cast("double"), value(df, b).cast("double")
                out[f"{a}_multiply_{b}"] = left * right
                out[f"{a}_add_{b}"] = left + right
                out[f"{a}_divide_{b}"] = safe_divide(left, right)
        return out


class PolynomialFeatures(FeatureStep):
    """Monomials of degree 2..``degree``: ``<a>_pow2``, ``<a>_x_<b>``.

    ``as_vector`` gives one vector column ``polynomial`` instead, for inputs too wide for one
    column per monomial; rows with a missing input get NULL there.
    """

    defaults = {"degree": 2, "as_vector": False}

    def _fit(self, df: DataFrame) -> "FeatureModel":
        columns, degree = self.numeric(df), self.opt("degree")
        if self.opt("as_vector"):
            return PolynomialVectorModel(columns=columns, degree=degree, names=["polynomial"])
        terms = [
            [[c, term.count(c)] for c in dict.fromkeys(term)]
            for d in range(2, degree + 1) for term in combinations_with_replacement(columns, d)
        ]
        return PolynomialFeaturesModel(terms=terms, names=[_monomial(t) for t in terms])


def _monomial(term) -> str:
    return "_x_".join(c if power == 1 else f"{c}_pow{power}" for c, power in term)


class PolynomialFeaturesModel(FeatureModel):
    def expressions(self, df: DataFrame) -> dict[str, Column]:
        out = {}
        for term in self.fitted["terms"]:
            if all(c in df.columns for c, _ in term):
                factors = [value(df, c).cast("double") for c, power in term for _ in range(power)]
                product = factors[0]
                for f in factors[1:]:
                    product = product * f
                out[_monomial(term)] = product
        return out


class PolynomialVectorModel(FeatureModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        columns = present(df, self.fitted["columns"])
        parts = append_columns(df, {f"__{c}": value(df, c).cast("double") for c in columns})
        complete = F.lit(True)
        for c in columns:
            complete = complete & quoted(f"__{c}").isNotNull()
        assembled = VectorAssembler(
            inputCols=[f"__{c}" for c in columns], outputCol="__in", handleInvalid="keep"
        ).transform(parts)
        grown = PolynomialExpansion(inputCol="__in", outputCol="__out", degree=self.fitted["degree"]).transform(assembled)
        return grown.select(*[quoted(c) for c in df.columns], F.when(complete, F.col("__out")).alias("polynomial"))


DATE_PARTS = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "dayofweek": F.weekday,  # Monday is 0
    "is_weekend": lambda c: (F.weekday(c) >= 5).cast("int"),
}


class DatetimeFeatures(FeatureStep):
    """``<column>_<part>``; the parts are chosen by ``features``."""

    defaults = {"features": ["year", "month", "day", "dayofweek", "is_weekend"]}

    def _fit(self, df: DataFrame) -> "DatetimeFeaturesModel":
        parts = self.opt("features")
        unknown = set(parts) - set(DATE_PARTS)
        if unknown:
            raise ValueError(f"unknown date parts: {sorted(unknown)}")
        columns = self.resolve(df, datetime_columns)
        return DatetimeFeaturesModel(
            columns=columns, parts=list(parts), names=[f"{c}_{p}" for c in columns for p in parts]
        )


class DatetimeFeaturesModel(FeatureModel):
    def expressions(self, df: DataFrame) -> dict[str, Column]:
        return {
            f"{c}_{p}": DATE_PARTS[p](quoted(c))
            for c in present(df, self.fitted["columns"]) for p in self.fitted["parts"]
        }


class CategoryFeatures(FeatureStep):
    """``<column>_count``, ``_frequency``, ``_is_rare`` from the fitted table.

    Missing is a category of its own; a category never seen has count 0 and is rare.
    """

    defaults = {"min_frequency": 10, "max_local": 20_000}

    def _fit(self, df: DataFrame) -> "CategoryFeaturesModel":
        columns = self.strings(df)
        table = CategoryTable.build(
            df, columns, {"n": F.count(F.lit(1))}, max_local=self.opt("max_local")
        )
        names = [f"{c}_{k}" for c in columns for k in ("count", "frequency", "is_rare")]
        return CategoryFeaturesModel(
            table=table, rows=df.count(), min_frequency=self.opt("min_frequency"), names=names
        )


class CategoryFeaturesModel(FeatureModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        columns = present(df, self.fitted["table"]["columns"])
        names = df.columns
        for c in columns:
            df = CategoryTable.join(
                df, self.fitted["table"], c, {"n": "bigint"}, {"n": f"{c}_count"}, {"n": 0}
            )
        total = F.lit(float(max(1, self.fitted["rows"])))
        out = [quoted(n) for n in names]
        for c in columns:
            n = quoted(f"{c}_count")
            out += [
                n, (n / total).alias(f"{c}_frequency"),
                (n < F.lit(self.fitted["min_frequency"])).cast("int").alias(f"{c}_is_rare"),
            ]
        return df.select(*out)


GROUP_AGGREGATES = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "count": F.count}


class GroupAggregateFeatures(FeatureStep):
    """``<category>_<number>_<mean|std|min|max|count>``: all pairs from one grouped aggregate."""

    defaults = {
        "categories": None, "aggregates": ["mean", "std", "min", "max", "count"], "max_local": 20_000,
    }

    def _fit(self, df: DataFrame) -> "GroupAggregateFeaturesModel":
        from tabloom.operators.stats import string_columns

        categories = self.resolve(df, string_columns, "categories")
        numbers, kinds = self.numeric(df), self.opt("aggregates")
        stats = {
            f"{n}_{k}": GROUP_AGGREGATES[k](value(df, n).cast("double")) for n in numbers for k in kinds
        }
        table = CategoryTable.build(df, categories, stats, max_local=self.opt("max_local"))
        return GroupAggregateFeaturesModel(
            table=table, stats=list(stats), counts=[f"{n}_count" for n in numbers if "count" in kinds],
            names=[f"{c}_{s}" for c in categories for s in stats],
        )


class GroupAggregateFeaturesModel(FeatureModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        stats, counts = self.fitted["stats"], self.fitted["counts"]
        kinds = {s: "bigint" if s in counts else "double" for s in stats}
        for c in present(df, self.fitted["table"]["columns"]):
            df = CategoryTable.join(
                df, self.fitted["table"], c, kinds, {s: f"{c}_{s}" for s in stats}, dict.fromkeys(counts, 0)
            )
        return df


class TargetEncodingFeatures(FeatureStep):
    """``<column>_target_enc``: out-of-fold on the fitted table, full means on any other."""

    defaults = {"folds": 5, "seed": 42, "max_local": 20_000}

    def _fit(self, df: DataFrame) -> "TargetEncodingFeaturesModel":
        if not self.opt("label"):
            raise ValueError("target encoding needs a label column")
        columns = self.strings(df)
        label = value(df, self.opt("label")).cast("double")
        table = CategoryTable.build(df, columns, {"mean": F.avg(label)}, max_local=self.opt("max_local"))
        unknown = {c: _missing_mean(df.sparkSession, table, c) for c in columns}
        return TargetEncodingFeaturesModel(
            table=table, unknown=unknown, names=[f"{c}_target_enc" for c in columns]
        )

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.out_of_fold(df)

    def out_of_fold(self, df: DataFrame) -> DataFrame:
        if not self.opt("key"):
            raise ValueError("out-of-fold encoding needs a row key")
        for c in self.strings(df):
            df = out_of_fold_target(
                df, c, self.opt("label"), self.opt("key"), f"{c}_target_enc", self.opt("folds"), self.opt("seed"),
                null_as=MISSING,
            )
        return df


class TargetEncodingFeaturesModel(FeatureModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        for c in present(df, self.fitted["table"]["columns"]):
            df = CategoryTable.join(
                df, self.fitted["table"], c, {"mean": "double"}, {"mean": f"{c}_target_enc"},
                {"mean": self.fitted["unknown"][c]},
            )
        return df

"""Contracts of the fitted transforms, features, chains and cleaning functions on small tables."""

import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tabloom.functions import clean_numeric, clean_string, clip, ordinal, safe_divide
from tabloom.operators.encode import CategoricalEncoder
from tabloom.operators.features import (
    CategoryFeatures,
    DatetimeFeatures,
    InteractionFeatures,
    NumericFeatures,
    PolynomialFeatures,
)
from tabloom.operators.impute import Imputer, any_null, null_profile
from tabloom.operators.outliers import OutlierClipper
from tabloom.operators.scale import Scaler
from tabloom.operators.select import FeatureSelector
from tabloom.operators.stats import numeric_columns
from tabloom.plans.chain import Chain, FunctionStep, Preprocessor, default_steps, quick_preprocess
from tabloom.plans.feature_set import AutoFeatures, FeatureSet
from tabloom.plans.presets import COMPETITIONS, PRESETS, ProblemConfig, competition, preset
from tabloom.sources.tables import missing_as_null


def stat(df, expression):
    return df.agg(expression).first()[0]


def no_nulls(df):
    return not any_null(df).first()["has_nulls"]


# missing values

def test_mean_imputation_keeps_the_mean(regression):
    before = stat(regression, F.avg("num1"))
    out = Imputer(key="id", label="target").fit(regression).transform(regression)
    assert stat(out, F.avg("num1")) == pytest.approx(before)
    assert no_nulls(out.select("num1", "cat1"))


def test_mode_imputation(regression):
    counts = regression.dropna(subset=["cat1"]).groupBy("cat1").count().orderBy(F.desc("count"), "cat1").first()
    model = Imputer(key="id", label="target").fit(regression)
    assert model.fitted["fills"]["cat1"] == counts["cat1"]


def test_only_columns_with_gaps_are_imputed(regression):
    assert set(Imputer(key="id").fit(regression).fitted["fills"]) == {"num1", "cat1"}
    every = Imputer(key="id", label="target", always=True).fit(regression).fitted["fills"]
    assert set(every) == {"num1", "num2", "cat1", "cat2"}


def test_unknown_settings_and_strategies(regression):
    with pytest.raises(ValueError):
        Imputer(nonsense=1)
    with pytest.raises(ValueError):
        Imputer(numeric_strategy="nonsense").fit(regression)
    for step in (OutlierClipper, Scaler, CategoricalEncoder):
        with pytest.raises(ValueError):
            step(method="nonsense").fit(regression)


def test_most_frequent_takes_the_smallest_of_a_tie(spark):
    df = spark.createDataFrame([(1, 3.0, "b"), (2, 3.0, "a"), (3, 2.0, "a"), (4, 2.0, "b"), (5, None, None)], "id int, x double, s string")
    fills = Imputer(key="id", numeric_strategy="most_frequent").fit(df).fitted["fills"]
    assert fills == {"x": 2.0, "s": "a"}


def test_column_without_values(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, None)], "id int, x double, s string")
    model = Imputer(key="id").fit(df)
    assert model.fitted["fills"] == {"s": "missing"}
    assert OutlierClipper(key="id").fit(df).fitted["bounds"] == {}
    assert Scaler(key="id", method="robust").fit(df).fitted["scales"] == {}


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, 3.0), (4, None)], "id int, x double")
    assert null_profile(df).first()["x"] == 2
    assert null_profile(missing_as_null(df)).first()["x"] == 2
    out = Imputer(key="id").fit(df).transform(df)
    assert [r["x"] for r in out.orderBy("id").collect()] == [1.0, 2.0, 3.0, 2.0]
    assert Scaler(key="id").fit(df).fitted["scales"]["x"] == [2.0, 1.0]


def test_booleans_are_not_numeric(spark):
    df = spark.createDataFrame([(1, True, 2.5)], "id int, flag boolean, x double")
    assert numeric_columns(df, exclude=["id"]) == ["x"]


# outliers, scaling, encoding, selection

def test_clipping_keeps_rows_and_nulls(regression):
    out = OutlierClipper(key="id", label="target").fit(regression).transform(regression)
    assert out.count() == regression.count() and out.columns == regression.columns
    assert null_profile(out).first() == null_profile(regression).first()


def test_standard_scale(regression):
    out = Scaler(key="id", label="target").fit(regression).transform(regression)
    assert stat(out, F.avg("num2")) == pytest.approx(0, abs=1e-9)
    assert stat(out, F.stddev_pop("num2")) == pytest.approx(1)


def test_minmax_scale_and_zero_width(spark):
    df = spark.createDataFrame([(1, 4, 7.0), (2, 8, 7.0)], "id int, a int, b double")
    out = Scaler(key="id", method="minmax").fit(df).transform(df).orderBy("id").collect()
    assert [(r["a"], r["b"]) for r in out] == [(0.0, 0.0), (1.0, 0.0)]


def test_label_codes_with_unknown_and_missing(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "k string")
    test = spark.createDataFrame([("a",), ("b",), (None,), ("new",)], "k string")
    out = [r["k"] for r in CategoricalEncoder().fit(train).transform(test).collect()]
    assert out == [0, 1, 2, -1]


def test_one_hot_columns(spark):
    train = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, k string")
    out = CategoricalEncoder(key="id", method="onehot").fit(train).transform(
        spark.createDataFrame([(1, "a"), (2, "?"), (3, None)], "id int, k string"))
    assert out.columns == ["id", "k_a", "k_b", "k_nan"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 1, 0, 0), (2, 0, 0, 0), (3, 0, 0, 1)]


def test_target_encoding_needs_a_label(regression):
    with pytest.raises(ValueError):
        CategoricalEncoder(method="target").fit(regression)


def test_correlation_selection(spark):
    rows = [(i, float(i), float(i % 7), 3.0, "s", 2.0 * i) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, good double, weak double, flat double, s string, y double")
    step = FeatureSelector(key="id", label="y", method="correlation", n_features=1)
    assert step.fit(df).selected_features == ["good", "s"]
    assert FeatureSelector(key="id", label="y", method="correlation", threshold=0.9).fit(df).selected_features == ["good", "s"]
    assert FeatureSelector(key="id", label="y").fit(df).selected_features == ["good", "weak", "s"]
    assert FeatureSelector(key="id", method="correlation").fit(df).selected_features == ["good", "weak", "flat", "s", "y"]


def test_selection_ignores_columns_that_are_gone(spark):
    df = spark.createDataFrame([(1, 2.0, 9.0), (2, 8.0, 1.0)], "id int, a double, b double")
    model = FeatureSelector(key="id").fit(df)
    assert model.transform(df.drop("a")).columns == ["id", "b"]


# functions

def test_cleaning(spark):
    df = spark.createDataFrame([(-1.0, "　 poor\t"), (0.0, "Excellent "), (3.0, "??"), (None, None)], "x double, s string")
    rows = df.select(
        clean_numeric("x").alias("a"), clean_numeric("x", 0, 2).alias("b"), clean_string("s").alias("s"),
        ordinal("s").alias("o"), clip("x", 0.0, 2.0).alias("c"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (None, None, "POOR", 1, 0.0), (None, 0.0, "EXCELLENT", 4, 0.0), (3.0, None, "??", None, 2.0), (None,) * 5,
    ]


def test_division(spark):
    df = spark.createDataFrame([(4.0, 2.0), (4.0, 0.0), (None, 0.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(safe_divide("a", "b")).collect()] == [2.0, 0.0, None, None]


# features

def test_numeric_features_are_finite(regression):
    out = NumericFeatures(key="id", transformations=["log", "sqrt"]).fit_transform(regression)
    made = [c for c in out.columns if c.endswith(("_log", "_sqrt"))]
    assert len(made) == 6 and no_nulls(out.select(*made))
    low, nan = out.agg(F.min("num1_sqrt"), F.count_if(F.isnan("num1_log"))).first()
    assert low >= 0 and nan == 0


def test_feature_names(regression):
    names = NumericFeatures(columns=["num1"]).fit(regression).get_feature_names_out()
    assert names == ["num1_log", "num1_sqrt", "num1_square"]
    assert InteractionFeatures(columns=["num1", "num2"]).fit(regression).get_feature_names_out() == [
        "num1_multiply_num2", "num1_add_num2", "num1_divide_num2"]
    assert PolynomialFeatures(columns=["num1", "num2"]).fit(regression).get_feature_names_out() == [
        "num1_pow2", "num1_x_num2", "num2_pow2"]


def test_category_features(regression):
    out = CategoryFeatures(min_frequency=5).fit_transform(regression)
    low, high = out.agg(F.min("cat1_frequency"), F.max("cat1_frequency")).first()
    assert 0 <= low <= high <= 1
    assert out.filter("cat1 is null").select("cat1_count", "cat1_is_rare").distinct().collect() == [(3, 1)]


def test_division_features_stay_finite(regression):
    zero = regression.withColumn("num2", F.when(F.col("id") == 1, 0.0).otherwise(F.col("num2")))
    out = InteractionFeatures(columns=["num1", "num2"]).fit_transform(zero)
    assert out.filter(F.abs("num1_divide_num2") == math.inf).count() == 0


def test_date_features(spark):
    df = spark.sql("SELECT timestamp_ntz'2023-01-01 10:00:00' AS d, date'2023-01-02' AS e")
    row = DatetimeFeatures().fit_transform(df).first()
    assert (row["d_year"], row["d_month"], row["d_day"], row["d_dayofweek"], row["d_is_weekend"]) == (2023, 1, 1, 6, 1)
    assert (row["e_dayofweek"], row["e_is_weekend"]) == (0, 0)
    assert DatetimeFeatures(features=["is_weekend"]).fit_transform(df).columns == ["d", "e", "d_is_weekend", "e_is_weekend"]


def test_feature_set(regression):
    def build():
        return FeatureSet(label="target", key="id").add_numeric_features(["log"]).add_categorical_features()

    a, b = build(), build()
    first, second = a.fit_transform(regression), b.fit_transform(regression)
    assert first.count() == regression.count()
    assert first.columns[: len(regression.columns)] == regression.columns
    assert a.get_feature_names_out() == first.columns
    assert first.exceptAll(second).count() == 0
    with pytest.raises(ValueError):
        build().transform(regression)


def test_features_read_input_columns_only(regression):
    made = FeatureSet(label="target", key="id").add_numeric_features(["square"]).add_interaction_features()
    out = made.fit_transform(regression)
    assert [c for c in out.columns if "square" in c] == ["num1_square", "num2_square"]


def test_automatic_features_have_no_gaps(regression):
    config = {"target_encoding": True, "aggregation_features": True, "polynomial_features": True}
    out = AutoFeatures(config, label="target", key="id").fit_transform(regression.dropDuplicates(["id"]))
    assert no_nulls(out) and "cat1_target_enc" in out.columns
    assert out.count() == 100


# chains

def test_default_chain(regression):
    chain = Chain(label="target", key="id").fit(regression)
    out = chain.transform(regression)
    assert out.columns == ["id", "target", "num1", "num2", "cat1", "cat2"] and no_nulls(out)
    assert chain.get_feature_names_out() == ["num1", "num2", "cat1", "cat2"]
    assert out.exceptAll(chain.transform(regression.repartition(5))).count() == 0


def test_unfitted_chain(regression, tmp_path):
    chain = Chain(key="id")
    for call in (lambda: chain.transform(regression), chain.get_feature_names_out, lambda: chain.save(str(tmp_path))):
        with pytest.raises(ValueError):
            call()


def test_chain_settings(regression):
    chain = Chain(default_steps(), key="id", label="target")
    chain.set_params(numeric_scaler__method="minmax", missing_handler__numeric_strategy="median")
    assert chain.get_params()["numeric_scaler__method"] == "minmax"
    with pytest.raises(ValueError):
        chain.set_params(gone__method="x")
    chain.remove_step("feature_selector").add_step("twice", FunctionStep(lambda d: d.withColumn("n", F.col("num2") * 2)))
    assert "n" in chain.fit_transform(regression).columns


def test_chain_round_trip(regression, tmp_path):
    chain = Chain(label="target", key="id").fit(regression)
    chain.save(str(tmp_path / "chain"))
    again = Chain(key="id").load(str(tmp_path / "chain"))
    assert again.transform(regression).exceptAll(chain.transform(regression)).count() == 0


def test_steps_work_in_a_plain_spark_pipeline(regression, tmp_path):
    model = Pipeline(stages=[Imputer(key="id"), Scaler(key="id", columns=["num1"])]).fit(regression)
    model.write().overwrite().save(str(tmp_path / "p"))
    again = PipelineModel.load(str(tmp_path / "p"))
    assert again.transform(regression).exceptAll(model.transform(regression)).count() == 0


def test_statistics_come_from_the_fitted_table(spark):
    train = spark.createDataFrame([(1, 0.0), (2, 10.0)], "id int, x double")
    test = spark.createDataFrame([(9, 30.0)], "id int, x double")
    assert Scaler(key="id", method="minmax").fit(train).transform(test).first()["x"] == 3.0


def test_split_and_quick_preprocess(orders):
    done = quick_preprocess(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), "o_totalprice", "o_orderkey")
    n, held = orders.count(), done["test"].count()
    assert done["train"].count() + held == n and abs(held / n - 0.2) < 0.04
    assert done["train"].join(done["test"], "o_orderkey", "left_semi").count() == 0
    assert done["feature_names"] == ["o_custkey", "o_orderstatus"]


def test_exact_stratified_preparation(orders):
    train, test = Preprocessor(key="o_orderkey").prepare_data(orders, "o_orderstatus", stratify=True)
    for row in orders.groupBy("o_orderstatus").count().collect():
        part = test.filter(F.col("o_orderstatus") == row["o_orderstatus"]).count()
        assert part == math.ceil(0.2 * row["count"])
    assert train.count() + test.count() == orders.count()


def test_presets():
    assert set(PRESETS) == {"regression", "classification", "tabular", "time_series"}
    assert preset("regression").preprocessing["outlier_threshold"] == 2.0
    assert ProblemConfig(problem_type="classification").feature_engineering["target_encoding"] is True
    assert {competition(c).metric for c in COMPETITIONS} == {"rmse", "accuracy"}
    with pytest.raises(ValueError):
        preset("nonsense")


def test_fitted_chain_on_a_stream(spark, regression, tmp_path):
    """Fitted steps are projections and broadcast lookups, so they also run on a stream."""
    path = str(tmp_path / "in")
    regression.write.parquet(path)
    chain = Chain(label="target", key="id").fit(regression)
    stream = chain.transform(spark.readStream.schema(regression.schema).parquet(path))
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).exceptAll(chain.transform(regression)).count() == 0

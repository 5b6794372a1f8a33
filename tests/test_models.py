"""Models, ensembles, searches, blends, results."""

import json
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import blend
from tabloom.operators import metrics as M
from tabloom.operators.tracking import best_model, best_trial, early_stop, elapsed, latest_results, running_best
from tabloom.operators.validate import result_flags, validate_columns, validate_xy
from tabloom.plans.ensembles import BlendEnsemble, StackingEnsemble, VotingEnsemble, create_ensemble, diverse_ensembles
from tabloom.plans.models import (
    ModelConfig,
    ModelSet,
    available_models,
    default_models,
    ensemble_models,
    model_by_name,
    register_config,
    stopping_round,
    tuned_models,
)
from tabloom.plans.presets import preset
from tabloom.plans.search import (
    Search,
    SearchConfig,
    auto_search,
    choose_method,
    load_search,
    param_grid,
    preset_search,
    register_method,
    sample_params,
    trial_table,
)
from tabloom.plans.workflow import Workflow
from tabloom.sources.results import (
    ResultWriter,
    append_result,
    load_model_config,
    read_log,
    save_model_config,
    summarize_result,
    validate_result,
)
from tabloom.sources.tables import read_csv, replace_table, table_exists, table_info

QUICK = {"n_estimators": 4, "max_depth": 3}


@pytest.fixture(scope="module")
def nonlinear(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=(1000, 4))
    y = x[:, 0] ** 2 + x[:, 1] * x[:, 2] + rng.normal(0, 0.1, 1000)
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id bigint, f0 double, f1 double, f2 double, f3 double, y double").persist()


FEATURES = ["f0", "f1", "f2", "f3"]


@pytest.mark.parametrize("kind", ["xgboost", "lightgbm", "catboost"])
def test_boosters_learn(nonlinear, kind):
    model = model_by_name(kind, n_estimators=10).fit(nonlinear, FEATURES, "y")
    assert M.metric(model.predict(nonlinear, "p"), "r2", "y", "p") > 0.5
    assert set(model.get_feature_importance()) == set(FEATURES)


def test_same_seed_same_predictions(nonlinear):
    a = model_by_name("xgboost", **QUICK).fit(nonlinear, FEATURES, "y").predict(nonlinear, "p")
    b = model_by_name("xgboost", **QUICK).fit(nonlinear, FEATURES, "y").predict(nonlinear, "q")
    assert a.join(b.select("id", "q"), "id").filter("p <> q").count() == 0


@pytest.mark.parametrize("kind", ["linear", "ridge", "lasso", "elasticnet"])
def test_linear_models_match_closed_forms(spark, kind):
    rng = np.random.default_rng(0)
    x = rng.normal(3, 2, size=(200, 2))
    y = 5 + x @ [2.0, -1.0] + rng.normal(size=200)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, y double")
    model = model_by_name(kind, alpha=0.5).fit(df, ["a", "b"], "y")
    z = (x - x.mean(0)) / x.std(0)
    w, n = np.zeros(2), len(y)
    l1 = {"linear": 0, "ridge": 0, "lasso": 0.5, "elasticnet": 0.25}[kind]
    l2 = {"linear": 0, "ridge": 0.5 / n, "lasso": 0, "elasticnet": 0.25}[kind]
    for _ in range(500):  # coordinate descent on mean squares / 2 + l1 |w| + l2 / 2 w^2
        for j in range(2):
            r = z[:, j] @ (y - y.mean() - z @ w + z[:, j] * w[j]) / n
            w[j] = np.sign(r) * max(abs(r) - l1, 0) / (1 + l2)
    got = np.array([r["p"] for r in model.predict(df, "p").collect()])
    assert np.allclose(got, y.mean() + z @ w, atol=1e-4)


@pytest.mark.parametrize("kind", ["logistic", "ridge", "lasso", "xgboost"])
def test_probabilities(binary, kind):
    model = model_by_name(kind, "classification", **(QUICK if kind == "xgboost" else {})).fit(binary, ["x1", "x2"], "y")
    out = model.transform(binary, "p", "proba").toPandas()
    proba = np.vstack(out["proba"])
    assert proba.shape == (400, 2) and np.allclose(proba.sum(1), 1) and ((proba >= 0) & (proba <= 1)).all()
    assert (out["p"] == out["y"]).mean() > 0.8


def test_regression_has_no_probabilities(nonlinear):
    with pytest.raises(ValueError):
        model_by_name("ridge").fit(nonlinear, FEATURES, "y").predict_proba(nonlinear)
    with pytest.raises(ValueError):
        model_by_name("ridge").predict(nonlinear)


def test_more_than_two_classes(nonlinear):
    df = nonlinear.withColumn("k", F.when(F.col("f0") < -0.5, 0).when(F.col("f0") < 0.5, 1).otherwise(2))
    for kind in ("xgboost", "logistic"):
        model = model_by_name(kind, "classification", **(QUICK if kind == "xgboost" else {})).fit(df, FEATURES, "k")
        assert M.metric(model.predict(df, "p"), "accuracy", "k", "p") > 0.8


def test_model_names_and_sets():
    assert {"xgboost", "lightgbm", "catboost", "linear", "ridge", "lasso", "elasticnet", "logistic"} <= set(available_models())
    assert [m.name for m in default_models("classification")][-1] == "logistic_ridge"
    assert len(ensemble_models()) == 9 and len({m.name for m in ensemble_models()}) == 9
    assert [m.name for m in tuned_models()][:2] == ["xgb_conservative", "xgb_balanced"]
    assert model_by_name("catboost", iterations=7, depth=2).get_params()["n_estimators"] == 7
    with pytest.raises(ValueError):
        model_by_name("nonsense")
    register_config("mine", lambda target_type="regression", **p: ModelConfig("mine", "ridge", {"alpha": 3.0, **p}, target_type))
    assert model_by_name("mine").get_params()["alpha"] == 3.0


def test_model_round_trip(spark, nonlinear, tmp_path):
    models = ModelSet([model_by_name("ridge"), model_by_name("catboost", **QUICK)]).fit(nonlinear, FEATURES, "y")
    models.save(spark, str(tmp_path))
    again = ModelSet.load(spark, str(tmp_path))
    assert again.features == FEATURES
    assert again.predict(nonlinear).exceptAll(models.predict(nonlinear)).count() == 0


def test_config_round_trip(spark, tmp_path):
    config = ModelConfig("m", "ridge", {"alpha": 2.0})
    config.save(spark, str(tmp_path))
    assert ModelConfig.load(spark, "m", str(tmp_path)) == config
    assert load_model_config(spark, "absent", str(tmp_path)) is None
    save_model_config(spark, {"when": datetime(2024, 1, 2)}, "dated", str(tmp_path))
    assert json.dumps(load_model_config(spark, "dated", str(tmp_path))) == '{"when": "2024-01-02 00:00:00"}'


def test_quality_against_the_mean(nonlinear):
    train, held = nonlinear.filter("id % 10 < 7"), nonlinear.filter("id % 10 >= 7")
    spread = held.agg(F.var_pop("y")).first()[0]
    for m in default_models(n_estimators=10):
        scored = m.fit(train, FEATURES, "y", held).predict(held, "p")
        assert M.metric(scored, "mse", "y", "p") < 1.2 * spread


# ensembles

def test_blend_ensembles(nonlinear):
    bases = lambda: [model_by_name("linear"), model_by_name("catboost", **QUICK)]
    train, held = nonlinear.filter("id % 5 > 0"), nonlinear.filter("id % 5 = 0")
    scored = BlendEnsemble(bases()).fit(train, FEATURES, "y").transform(held, "avg")
    weighted = BlendEnsemble(bases(), "weighted").fit(train, FEATURES, "y", held)
    assert weighted.weights[0] < 1e-6 and sum(weighted.weights) == pytest.approx(1)
    assert weighted.transform(scored, "w").columns == [*nonlinear.columns, "avg", "w"]
    by_fold = BlendEnsemble(bases(), "weighted", key="id").fit(train, FEATURES, "y")
    assert by_fold.weights[0] < 1e-6
    with pytest.raises(ValueError):
        BlendEnsemble(bases(), "weighted").fit(train, FEATURES, "y")


def test_class_ensembles(binary):
    bases = [model_by_name("logistic"), model_by_name("ridge", "classification"), model_by_name("catboost", "classification", **QUICK)]
    for kind in ("average", "voting_soft", "voting_hard"):
        out = create_ensemble([b.copy() for b in bases], kind).fit(binary, ["x1", "x2"], "y").transform(binary, "p")
        assert M.metric(out, "accuracy", "y", "p") > 0.85
        assert set(r["p"] for r in out.select("p").distinct().collect()) == {0.0, 1.0}
    stack = StackingEnsemble(bases[:2], key="id", folds=3).fit(binary, ["x1", "x2"], "y").transform(binary, "p")
    assert M.metric(stack, "accuracy", "y", "p") > 0.85


def test_ensemble_kinds(nonlinear):
    with pytest.raises(ValueError):
        create_ensemble([model_by_name("ridge")], "nonsense")
    with pytest.raises(ValueError):
        StackingEnsemble([model_by_name("ridge")])
    with pytest.raises(ValueError):
        VotingEnsemble([model_by_name("ridge")], "loud")
    average, weighted, stack = diverse_ensembles(key="id")
    assert [len(e.set.models) for e in (average, weighted, stack)] == [3, 3, 6]


def test_out_of_fold_rows_are_complete(nonlinear):
    stack = StackingEnsemble([model_by_name("ridge"), model_by_name("lasso", alpha=0.1)], key="id")
    meta = stack.meta_features(nonlinear, FEATURES, "y")
    assert meta.count() == 1000 and meta.select("id").distinct().count() == 1000
    assert meta.dropna().count() == 1000


# blends

def test_blends(spark):
    df = spark.createDataFrame([(0, 100.0, 200.0), (1, 100.0, 200.0)], "id int, a double, b double")
    assert {r[0] for r in df.select(blend.weighted(["a", "b"], weights=[0.3, 0.7])).collect()} == {170.0}
    assert df.select(blend.average(["a", "b"])).first()[0] == 150.0
    assert df.select(blend.geometric(["a", "b"])).first()[0] == pytest.approx(20000 ** 0.5)
    with pytest.raises(ValueError):
        blend.weighted(["a", "b"], weights=[1.0])


def test_rank_blend_of_opposite_orders(spark):
    df = spark.createDataFrame([(i, float(i), float(9 - i)) for i in range(10)], "id int, a double, b double")
    assert {r["r"] for r in blend.rank_average(df, ["a", "b"], "r").collect()} == {5.5}


def test_hard_vote_tie(spark):
    df = spark.createDataFrame([(1.0, 0.0, 2.0), (2.0, 2.0, 0.0)], "a double, b double, c double")
    assert [r[0] for r in df.select(blend.vote_hard(["a", "b", "c"])).collect()] == [0.0, 2.0]


def test_weights_of_equal_scores():
    assert blend.score_weights({"a": -2.0, "b": -2.0}) == {"a": 0.5, "b": 0.5}


# metrics

def test_metrics_of_a_hand_computed_table(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0)], "y double, p double")
    row = M.evaluate(df, "y", "p").first()
    assert row["mse"] == pytest.approx(5 / 3) and row["mae"] == 1.0 and row["r2"] == pytest.approx(1 - 5 / 2)
    assert row["mape"] == pytest.approx(100 * (1 + 0 + 2 / 3) / 3) and row["mean_residual"] == -1.0
    with pytest.raises(ValueError):
        M.evaluate(df, "y", "p", "nonsense")
    with pytest.raises(ValueError):
        M.metric(df, "nonsense", "y", "p")


def test_zero_over_zero_and_constant_target(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    row = M.binary_metrics(df, "y", "p").first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, p double")
    assert M.regression_metrics(flat, "y", "p").first()["r2"] is None


def test_certain_wrong_probability(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.0)], "y int, p double")
    assert M.metric(df, "logloss", "y", "p") == pytest.approx(36.04365338911715 / 2)


def test_leaderboard_order(spark):
    rows = [("a", "rmse", 3.0), ("a", "r2", 0.1), ("b", "rmse", 1.0), ("b", "r2", 0.9), ("c", "rmse", 2.0), ("c", "r2", 0.5)]
    long = spark.createDataFrame(rows, "model string, metric string, value double")
    assert [r["model"] for r in M.leaderboard(long).collect()] == ["b", "c", "a"]
    assert [r["model"] for r in M.leaderboard(long, "r2").collect()] == ["b", "c", "a"]


# searches

def test_grid_order(spark):
    rows = param_grid(spark, {"b": [1, 2], "a": ["x", "y", "z"]}).orderBy("trial").collect()
    assert [(r["a"], r["b"]) for r in rows] == [(a, b) for a in "xyz" for b in (1, 2)]
    assert param_grid(spark, {"a": [1, 2, 3]}, limit=2).count() == 2


def test_draws_stay_in_range(spark):
    space = {"u": {"type": "uniform", "low": 2, "high": 3}, "l": {"type": "loguniform", "low": 0.01, "high": 1},
             "i": {"type": "int", "low": 1, "high": 3}, "c": ["a", "b"], "k": 5}
    trials = sample_params(spark.range(500).withColumnRenamed("id", "trial"), space)
    row = trials.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in "uli" for f in (F.min, F.max)], F.count_distinct("c", "i").alias("n")).first()
    assert 2 <= row["min_u"] and row["max_u"] < 3 and 0.01 <= row["min_l"] and row["max_l"] < 1
    assert (row["min_i"], row["max_i"], row["n"]) == (1, 3, 6)
    assert trials.exceptAll(sample_params(spark.range(500).withColumnRenamed("id", "trial").repartition(3), space)).count() == 0
    with pytest.raises(ValueError):
        sample_params(trials, {"x": {"type": "nonsense"}})


def test_search(spark, nonlinear, tmp_path):
    config = SearchConfig({"alpha": [1.0, 1e6]}, n_trials=5, cv_folds=3)
    result = Search(config, "grid").run(model_by_name("ridge"), nonlinear, FEATURES, "y", key="id")
    assert result.summary()["n_trials"] == 2 and result.apply_best_params().get_params()["alpha"] == result.best["params"]["alpha"]
    assert result.param_importance().first()["importance"] == pytest.approx(1)
    result.save(str(tmp_path))
    saved, method, trials = load_search(spark, str(tmp_path))
    assert saved == config and method == "grid" and trials.count() == 2


def test_failed_trials_are_skipped(nonlinear):
    config = SearchConfig({"max_depth": [2, 99]}, n_trials=5)
    result = Search(config, "grid").run(model_by_name("catboost", **QUICK), nonlinear, FEATURES, "y", nonlinear)
    assert [t["params"]["max_depth"] for t in result.search.history] == [2]
    failed = result.failed().collect()
    assert [(r.params["max_depth"], bool(r.error)) for r in failed] == [("99", True)]


def test_patience(nonlinear):
    space = {"alpha": {"type": "uniform", "low": 1.0, "high": 1.0}}
    search = Search(SearchConfig(space, n_trials=20, early_stopping_rounds=2, threads=2), "optuna")
    search.run(model_by_name("ridge"), nonlinear, FEATURES, "y", nonlinear)
    assert len(search.history) == 3


def test_methods(spark):
    assert choose_method({"a": [1]}, 10) == "grid" and choose_method({"a": {"type": "int"}}, 10) == "random"
    assert choose_method({"a": [1]}, 50) == "random" and choose_method({"a": [1]}, 500) == "optuna"
    assert auto_search({"a": [1]}, 5).method == "grid"
    register_method("first", lambda s, c: param_grid(s, c.search_space, 1))
    assert Search(SearchConfig({"a": [1, 2]}), "first").method == "first"
    with pytest.raises(ValueError):
        Search(SearchConfig({}), "nonsense")
    assert preset_search("xgboost", "classification", "random").scoring == "f1_weighted"
    assert preset_search("catboost", kind="grid").search_space["n_estimators"] == [100, 500, 1000]
    with pytest.raises(ValueError):
        preset_search("ridge")


def test_trial_history(spark):
    scores = [1.0, 3.0, 2.0, 3.0, 4.0]
    trials = trial_table(spark, [{"trial": i, "params": {"a": i}, "score": s, "ts": 10.0 * i} for i, s in enumerate(scores)])
    assert [r["best_score"] for r in running_best(trials, span=2).orderBy("trial").collect()] == [1.0, 3.0, 3.0, 3.0, 4.0]
    assert best_trial(trials).first()["params"] == {"a": "4"}
    assert early_stop(trials, 2, span=2).first()["stopped_at"] == 3
    assert early_stop(trials, 3).first()["stopped_at"] is None
    assert elapsed(trials).first()["elapsed"] == 40.0


# results and tables

def test_result_files(spark, tmp_path):
    df = spark.createDataFrame([(10 + i, float(v)) for i, v in enumerate([1, 2, 3, 4, 5])], "k bigint, p double")
    writer = ResultWriter(str(tmp_path))
    path = writer.write(df, "p", order="k", name="r")
    assert [tuple(r) for r in writer.read(spark, path).orderBy("id").collect()] == [(i, i + 1.0) for i in range(5)]
    row = summarize_result(writer.read(spark, path), path).first()
    assert (row["mean"], row["min"], row["max"], row["unique_values"]) == (3.0, 1.0, 5.0, 5) and row["file_size_mb"] > 0
    assert row["std"] == pytest.approx(np.std([1, 2, 3, 4, 5], ddof=1))
    assert validate_result(spark, path, 5, ["id", "target"])
    assert not validate_result(spark, path, 6) and not validate_result(spark, path, 5, ["gone"])
    assert not validate_result(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError):
        writer.write(df, "p")
    nulls = spark.createDataFrame([(1, None)], "id int, target double")
    assert not result_flags(nulls).first()["valid"]


def test_log(spark, tmp_path):
    path = str(tmp_path / "log")
    append_result(spark, path, "a", 5.0, datetime(2024, 1, 1))
    append_result(spark, path, "a", 7.0, datetime(2024, 1, 3))
    append_result(spark, path, "b", 6.0, datetime(2024, 1, 2))
    log = read_log(spark, path)
    assert {r["model"]: r["rmse"] for r in latest_results(log).collect()} == {"a": 7.0, "b": 6.0}
    assert best_model(log).first()["model"] == "b"
    for score in (1.0, 2.0, 3.0):  # within one second the first one written counts
        append_result(spark, path, "c", score, datetime(2024, 1, 4))
    assert latest_results(read_log(spark, path)).filter("model = 'c'").first()["rmse"] == 1.0


def test_tables(spark, orders):
    assert not table_exists(spark, "no_such_table") and table_info(spark, "no_such_table").first()["row_count"] == 0
    replace_table(orders.limit(3), "replaced_in_tests")
    replace_table(orders.limit(2), "replaced_in_tests")
    assert table_info(spark, "replaced_in_tests").first()["row_count"] == 2


def test_checks(spark, orders):
    assert validate_columns(orders, ["o_orderkey"]) and not validate_columns(orders, ["gone"])
    assert not validate_columns(orders.limit(0), ["o_orderkey"])
    assert not validate_xy(None, orders) and not validate_xy(orders.limit(0), orders.limit(0))


def test_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,a,b\n1,2.5,x\n2,,\n")
    df = read_csv(spark, str(tmp_path / "t.csv"))
    assert dict(df.dtypes) == {"id": "int", "a": "double", "b": "string"}
    assert tuple(df.orderBy("id").collect()[1]) == (2, None, None)


def test_workflow(spark, regression, tmp_path):
    rows = regression.dropDuplicates(["id"]).persist()
    flow = Workflow("target", "id", models=[model_by_name("ridge"), model_by_name("catboost", **QUICK)]).fit(rows)
    scores = {r["model"]: r["rmse"] for r in flow.validation_metrics().collect()}
    assert set(scores) == {"ridge", "catboost"} and scores["catboost"] < 31
    paths = flow.write(rows.drop("target"), str(tmp_path))
    for path in paths.values():
        assert validate_result(spark, path, 100)


def test_patience_stops_after_the_best_round(nonlinear):
    assert stopping_round([5, 4, 4, 3, 6, 6, 6, 2], 3) == (3, True)
    assert stopping_round([5, 4, 3], 3) == (2, False)
    held = nonlinear.filter("id % 3 = 0")
    model = model_by_name("lightgbm", n_estimators=200, max_depth=5, learning_rate=0.9, early_stopping_rounds=2, subsample=1.0, colsample_bytree=1.0)
    model.fit(nonlinear.filter("id % 3 > 0"), FEATURES, "y", held)
    trees = model.model.stages[-1]
    assert 1 <= trees.getNumTrees < 200
    assembled = model.model.stages[0].transform(held.select(*FEATURES, "y"))
    losses = trees.evaluateEachIteration(assembled, "squared")
    assert min(range(len(losses)), key=losses.__getitem__) == len(losses) - 1


def test_settings_without_effect_are_refused():
    for kind, setting in (("xgboost", "reg_lambda"), ("lightgbm", "num_leaves"), ("ridge", "max_depth")):
        with pytest.raises(ValueError, match=setting):
            model_by_name(kind, **{setting: 5})
    with pytest.raises(ValueError, match="gamma"):
        model_by_name("xgboost").set_params(gamma=1)


def test_starting_rounds():
    assert [model_by_name(b).get_params()["n_estimators"] for b in ("xgboost", "lightgbm", "catboost")] == [1000] * 3
    assert {m.get_params()["n_estimators"] for m in tuned_models()} == {1000, 1500}


def test_settings_drive_the_workflow(spark, orders):
    rows = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    flow = Workflow.from_settings(preset("tabular"), "o_orderkey", "o_totalprice", n_estimators=2, max_depth=2).fit(rows)
    out = flow.predict(rows)
    assert out.columns == ["o_orderkey", "xgboost", "lightgbm", "catboost", "ensemble_average", "ensemble_weighted"]
    off = out.filter("abs(ensemble_average - (xgboost + lightgbm + catboost) / 3) > 1e-6 * abs(xgboost)")
    assert out.count() == rows.count() and off.count() == 0
    assert {"o_custkey_log", "o_custkey_square"} <= set(flow.inputs)
    search = Workflow.from_settings(preset("regression"), "o_orderkey").search({"alpha": [1.0]}, timeout=None)
    assert (search.method, search.config.n_trials, search.config.cv_folds) == ("optuna", 200, 5)


def test_time_series_settings_need_entity_and_order(spark, orders):
    rows = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    with pytest.raises(ValueError, match="entity"):
        Workflow.from_settings(preset("time_series"), "o_orderkey", "o_totalprice", n_estimators=2).fit(rows)

"""Boosting on histograms: against plain NumPy trees, any partitioning, patience, continued rounds, settings, edges."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators import metrics as M
from tabloom.operators.ordered import OrderedTargetEncoder, ordered_means
from tabloom.plans import boosting
from tabloom.plans.boosting import Booster, BoostSettings
from tabloom.plans.models import ModelSet, model_by_name

FEATURES = ["f0", "f1", "f2"]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(900, 3)), 2)
    y = x[:, 0] ** 2 + x[:, 1] * x[:, 2] + rng.normal(0, 0.1, 900)
    x[rng.random((900, 3)) < 0.05] = np.nan
    return pd.DataFrame({**{f: x[:, i] for i, f in enumerate(FEATURES)}, "y": y})


@pytest.fixture(scope="module")
def table(spark, frame):
    return spark.createDataFrame(frame).persist()


# a plain version, in floats, one node at a time

def gain_of(g, h, s):
    soft = lambda v: np.sign(v) * max(abs(v) - s.reg_alpha, 0)
    return soft(g) ** 2 / max(h + s.reg_lambda, 1e-16), -s.learning_rate * soft(g) / max(h + s.reg_lambda, 1e-16)


def cuts_of(bins, g, h, rows, s):
    """{(feature, bin, missing left): gain} of the rows of a node."""
    out = {}
    for f in range(len(bins)):
        for b in range(1, bins[f].max() + 1):
            for missing_left in (True, False):
                if not missing_left and not (bins[f][rows] == 0).any():
                    continue
                left = rows & np.where(bins[f] == 0, missing_left, bins[f] <= b)
                right = rows & ~left
                if min(left.sum(), right.sum()) < max(1, s.min_child_samples) or min(h[left].sum(), h[right].sum()) < s.min_child_weight - 1e-9:
                    continue
                parts = [gain_of(g[m].sum(), h[m].sum(), s)[0] for m in (left, right, rows)]
                out[f, b, missing_left] = 0.5 * (parts[0] + parts[1] - parts[2]) - s.gamma
    return out


def parted(bins, rows, f, b, missing_left):
    left = rows & np.where(bins[f] == 0, missing_left, bins[f] <= b)
    return left, rows & ~left


def plain_tree(bins, g, h, s):
    """Leaves as row masks."""
    everything = np.ones(len(g), bool)
    best = lambda rows: max(cuts_of(bins, g, h, rows, s).items(), key=lambda kv: kv[1], default=(None, 0))
    if s.growth == "symmetric":
        leaves = [everything]
        for _ in range(s.max_depth):
            total: dict = {}
            for cuts in (cuts_of(bins, g, h, rows, s) for rows in leaves):
                for k, v in cuts.items():
                    total[k] = total.get(k, 0) + v
            cut = max(total.items(), key=lambda kv: kv[1], default=(None, 0))
            if cut[1] <= 0:
                break
            leaves = [part for rows in leaves for part in parted(bins, rows, *cut[0])]
        return leaves
    leaves, done = [(best(everything), everything, 0)], []
    limit = s.num_leaves if s.growth == "leaf" else 10**9
    while leaves:
        at = max(range(len(leaves)), key=lambda i: leaves[i][0][1])
        (cut, gain), rows, depth = leaves.pop(at)
        if gain <= 0 or depth >= s.max_depth or len(leaves) + len(done) + 1 >= limit:
            done.append(rows)
            continue
        leaves += [(best(part), part, depth + 1) for part in parted(bins, rows, *cut)]
    return done


def plain_boost(bins, y, s, base):
    f = np.full(len(y), base)
    for _ in range(s.n_estimators):
        g, h, _ = boosting.gradients(y, f, s.objective)
        for rows in plain_tree(bins, g, h, s):
            if rows.any():
                f[rows] += gain_of(g[rows].sum(), h[rows].sum(), s)[1]
    return f


SETTINGS = [
    dict(growth="level", max_depth=3, reg_lambda=2.0, reg_alpha=0.5, gamma=0.3, min_child_weight=4),
    dict(growth="level", max_depth=3, objective="logistic", reg_lambda=0.5, min_child_weight=1.5),
    dict(growth="leaf", num_leaves=7, max_depth=5, reg_lambda=0.1, min_child_samples=9),
    dict(growth="leaf", num_leaves=5, max_depth=2, reg_lambda=1.0),
    dict(growth="symmetric", max_depth=3, reg_lambda=3.0, min_child_weight=0.0),
]


def label_of(frame, s):
    return (frame["y"] > 0.4).astype(float) if s.objective == "logistic" else frame["y"]


@pytest.mark.parametrize("at", range(len(SETTINGS)))
def test_trees_are_those_of_the_plain_version(spark, frame, at):
    s = BoostSettings(n_estimators=3, learning_rate=0.4, max_bins=12, **SETTINGS[at])
    y = label_of(frame, s)
    booster = Booster(spark.createDataFrame(frame.assign(y=y)), FEATURES, "y", s)
    bins = np.array([np.where(frame[f].isna(), 0, 1 + np.searchsorted(c, frame[f], "left")) for f, c in zip(FEATURES, booster.cuts)])
    want = plain_boost(bins, y.to_numpy(), s, booster.base)
    model = booster.fit()
    booster.close()
    got = boosting.margins(model.fitted, [frame[f].to_numpy() for f in FEATURES])
    assert np.allclose(got, want, atol=1e-6)
    scored = model.transform(spark.createDataFrame(frame)).toPandas()
    assert np.allclose(scored["__prediction"], want if s.objective == "squared" else want > 0, atol=1e-6)


@pytest.mark.parametrize("growth", ["level", "leaf", "symmetric"])
def test_any_partitioning_and_both_ways_of_adding_up(spark, table, growth, monkeypatch):
    s = BoostSettings(n_estimators=3, growth=growth, max_depth=4, num_leaves=9, learning_rate=0.3)
    first = Booster(table.coalesce(1), FEATURES, "y", s).fit().fitted
    monkeypatch.setattr(boosting, "BLOCK", 64)
    monkeypatch.setattr(boosting, "LIGHT", 0)
    monkeypatch.setattr(boosting, "PENDING", 2)
    booster = Booster(table.repartition(5), FEATURES, "y", s)
    assert booster.tasks > 1 and not booster.light
    assert booster.fit().fitted["trees"] == first["trees"]


def test_patience_cuts_the_longest_run_at_its_best_round(spark, table):
    train, held = table.filter("f2 < 0.6 or f2 is null"), table.filter("f2 >= 0.6")
    s = dict(max_depth=3, learning_rate=0.9, reg_lambda=0.0)
    whole = Booster(train, FEATURES, "y", BoostSettings(n_estimators=25, **s), held)
    longest = whole.fit()
    assert len(whole.losses) == len(longest.fitted["trees"]) == 25
    rounds = []
    some = Booster(train, FEATURES, "y", BoostSettings(n_estimators=25, early_stopping_rounds=3, **s), held)
    model = some.fit(on_round=lambda b: rounds.append(len(b.trees)))
    assert rounds == list(range(1, len(rounds) + 1)) and len(rounds) < 25  # every round was fitted once
    best = int(np.argmin(some.losses))
    assert some.losses == whole.losses[: len(some.losses)]
    assert len(some.losses) - 1 - best >= 3 or len(rounds) == 25
    assert model.fitted["trees"] == longest.fitted["trees"][: best + 1]
    x = held.toPandas()
    mse = np.mean((boosting.margins(model.fitted, [x[f].to_numpy() for f in FEATURES]) - x["y"]) ** 2)
    assert abs(mse - some.losses[best]) < 1e-4


@pytest.mark.parametrize("more", [
    dict(growth="symmetric"), dict(growth="level", objective="logistic", subsample=0.7, colsample_bytree=0.7),
    dict(growth="leaf", num_leaves=6, top_rate=0.3, other_rate=0.2),
])
def test_a_small_table_takes_few_jobs_for_the_same_trees(spark, frame, more, monkeypatch):
    df = spark.createDataFrame(frame.assign(y=frame["y"] > 0.4 if "objective" in more else frame["y"])).withColumn("y", F.col("y").cast("double"))
    parts = df.filter("f2 < 0.6 or f2 is null").coalesce(1), df.filter("f2 >= 0.6").coalesce(1)
    s = BoostSettings(n_estimators=40, max_depth=3, learning_rate=0.9, early_stopping_rounds=8, **more)
    monkeypatch.setattr(boosting, "ROUNDS", 11)
    one = Booster(parts[0], FEATURES, "y", s, parts[1])
    sc = spark.sparkContext
    sc.setJobGroup("rounds of one task", "")
    first = one.fit().fitted
    jobs = len(sc.statusTracker().getJobIdsForGroup("rounds of one task"))
    sc.setJobGroup("others", "")
    assert jobs < len(one.trees)
    monkeypatch.setattr(boosting, "ALONE", 0)
    other = Booster(parts[0], FEATURES, "y", s, parts[1])
    assert other.fit().fitted["trees"] == first["trees"] and other.losses == one.losses


def test_rounds_can_be_added(spark, table):
    s = BoostSettings(n_estimators=6, max_depth=3, subsample=0.7, colsample_bytree=0.7)
    whole = Booster(table, FEATURES, "y", s).fit()
    parts = Booster(table, FEATURES, "y", BoostSettings(**{**s.__dict__, "n_estimators": 2}))
    parts.fit()
    parts.s.n_estimators = 6
    assert parts.fit().fitted["trees"] == whole.fitted["trees"]


def test_sampling_by_gradient(spark, table):
    booster = Booster(table, FEATURES, "y", BoostSettings(n_estimators=12, growth="leaf", num_leaves=8, top_rate=0.3, other_rate=0.2, learning_rate=0.3))
    threshold = booster._gradient_threshold()
    y = np.array([r.y for r in table.collect()])
    assert 0.3 <= np.mean(np.abs(y - y.mean()) >= threshold) < 0.33
    x = table.toPandas()
    got = boosting.margins(booster.fit().fitted, [x[f].to_numpy() for f in FEATURES])
    assert np.mean((got - y) ** 2) < 0.5 * y.var()


@pytest.mark.parametrize("kind,more", [
    ("xgboost", {"reg_lambda": 2, "reg_alpha": 0.1, "gamma": 0.01, "min_child_weight": 3}),
    ("lightgbm", {"num_leaves": 15, "min_child_samples": 5}), ("catboost", {"l2_leaf_reg": 5, "iterations": 10}),
])
def test_settings_are_taken(spark, table, tmp_path, kind, more):
    model = model_by_name(kind, engine="histogram", **{"n_estimators": 10, **({} if "iterations" in more else {})}, **{k: v for k, v in more.items() if k != "iterations"}, learning_rate=0.3)
    ModelSet([model]).fit(table, FEATURES, "y").save(spark, str(tmp_path))
    assert M.metric(model.predict(table, "p"), "r2", "y", "p") > 0.5
    assert set(model.get_feature_importance()) == set(FEATURES) and abs(sum(model.get_feature_importance().values()) - 1) < 1e-9
    again = ModelSet.load(spark, str(tmp_path)).models[0]
    assert again.predict(table, "p").exceptAll(model.predict(table, "p")).count() == 0
    with pytest.raises(ValueError, match="engine"):
        model_by_name(kind, engine="magic")
    with pytest.raises(ValueError, match="nonsense"):
        model_by_name(kind, engine="histogram", nonsense=1)


def test_classes(spark, table):
    df = table.withColumn("k", F.when(F.col("y") < 0, 0).when(F.col("y") < 1, 1).otherwise(2)).withColumn("two", (F.col("y") > 0.5).cast("int"))
    quick = {"engine": "histogram", "n_estimators": 8, "max_depth": 4, "learning_rate": 0.5}
    model = model_by_name("xgboost", "classification", **quick).fit(df, FEATURES, "two")
    out = model.transform(df, "p", "proba").toPandas()
    proba = np.vstack(out["proba"])
    assert np.allclose(proba.sum(1), 1) and (out["p"] == out["two"]).mean() > 0.85
    model = model_by_name("lightgbm", "classification", **quick).fit(df, FEATURES, "k")
    out = model.transform(df, "p", "proba").toPandas()
    assert np.allclose(np.vstack(out["proba"]).sum(1), 1) and (out["p"] == out["k"]).mean() > 0.8


def test_categories_as_ordered_statistics(spark):
    rng = np.random.default_rng(5)
    k = rng.integers(0, 30, 1500)
    rows = [(i, f"c{c}" if c else None, float(rng.normal()), float((c % 7) * 3 + rng.normal() * 0.3)) for i, c in enumerate(k.tolist())]
    df = spark.createDataFrame(rows, "id long, c string, x double, y double")
    train, held = df.filter("id % 4 > 0"), df.filter("id % 4 = 0")
    model = model_by_name("catboost", engine="histogram", cat_features=["c"], key="id", n_estimators=40, learning_rate=0.3, early_stopping_rounds=5)
    model.fit(train, ["x", "c"], "y", held)
    scored = model.predict(held.withColumn("c", F.when(F.col("id") % 100 == 0, "new").otherwise(F.col("c"))), "p")
    assert scored.columns == ["id", "c", "x", "y", "p"]
    assert M.metric(scored.filter("id % 100 > 0"), "r2", "y", "p") > 0.9
    assert model.get_feature_importance()["c"] > 0.8


@pytest.mark.parametrize("range_rows", [10**6, 50])
def test_ordered_means_see_earlier_rows_only(spark, range_rows):
    from tabloom.functions.hashing import hash28

    rng = np.random.default_rng(1)
    rows = [(i, None if i % 11 == 0 else "hot" if i % 3 else f"c{i % 5}", None if i % 13 == 0 else float(rng.normal())) for i in range(800)]
    df = spark.createDataFrame(rows, "id long, c string, y double")
    order = {r.id: (r.h, r.id) for r in df.select("id", hash28("id").alias("h")).collect()}
    got = {r.id: r.c_ordered for r in ordered_means(df, ["c"], "y", "id", 0.25, 2.0, range_rows=range_rows).collect()}
    sums = {}
    for i, c, y in sorted(rows, key=lambda r: order[r[0]]):
        s, n = sums.get(c, (0.0, 0))
        assert abs(got[i] - (s + 0.5) / (n + 2)) < 1e-9
        sums[c] = (s + (y or 0.0), n + (y is not None))
    encoder = OrderedTargetEncoder(columns=["c"], label="y", key="id").fit(df)
    new = encoder.transform(spark.createDataFrame([(1, "?"), (2, "hot")], "id long, c string")).collect()
    mean = np.mean([y for *_, y in rows if y is not None])
    assert abs(new[0].c - mean) < 1e-9 and abs(new[1].c - (sums["hot"][0] + mean) / (sums["hot"][1] + 1)) < 1e-9


def test_edges(spark, table):
    flat = table.select(F.lit(1.0).alias("f0"), F.lit(None).cast("double").alias("f1"), F.lit(2.0).alias("y"))
    model = Booster(flat, ["f0", "f1"], "y", BoostSettings(n_estimators=3)).fit()
    assert {r["__prediction"] for r in model.transform(flat).collect()} == {2.0}
    none = Booster(table.limit(0), FEATURES, "y", BoostSettings(n_estimators=3)).fit()
    assert none.getNumTrees == 0 and none.transform(table).count() == table.count()
    one = Booster(table.limit(1), FEATURES, "y", BoostSettings(n_estimators=3, growth="symmetric")).fit()
    assert one.getNumTrees == 3


def test_default_rounds_with_patience_on_orders(spark):
    from __spark_entry__ import queries

    found = queries()["gbt_patience"](spark, "/root/testdata/sf0.001").filter("held")
    row = found.agg(F.avg(F.pow(F.col("y") - F.col("p"), 2)).alias("mse"), F.var_pop("y").alias("spread"), F.max("n_trees").alias("trees")).first()
    assert row.mse < 0.1 * row.spread and 1 < row.trees < 1000

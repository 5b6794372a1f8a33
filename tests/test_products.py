"""Cross-products of column blocks, and linear models solved from them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import products
from tabloom.operators.select import FeatureSelector
from tabloom.operators.split import fold_of
from tabloom.plans import gram
from tabloom.plans.models import model_by_name
from tabloom.plans.search import Search, SearchConfig


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 7)) * [1, 5, 0.1, 1, 1, 1, 0] + [1e6, 0, 3, 0, 0, 0, 7]
    x[:, 4] = x[:, 1] + 0.01 * x[:, 3]
    x[rng.random(400) < 0.2, 5] = np.nan
    y = x[:, :4] @ [0.5, 1.0, -3.0, 0.2] + rng.normal(size=400)
    y[rng.random(400) < 0.1] = np.nan
    rows = [(i, *(None if np.isnan(v) else float(v) for v in [*a, b])) for i, (a, b) in enumerate(zip(x, y))]
    names = [f"c{i}" for i in range(7)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in names) + ", y double").repartition(3), x, y, names


@pytest.mark.parametrize("block", [2, 3, 256])
def test_pairwise_correlations(numbers, block):
    df, x, y, names = numbers
    got = {(r.a, r.b): r["corr"] for r in products.correlation_table(df, names, block).collect()}
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if 6 in (i, j):
                assert got[a, b] is None
            else:
                assert abs(got[a, b] - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-6
    assert len(got) == 49


def test_wide_selection(spark):
    """Columns whose statistics as expressions of one aggregate would not compile."""
    rng = np.random.default_rng(1)
    n = 1000
    x = rng.normal(size=(60, n))
    y = x[:, 17] + 0.1 * rng.normal(size=60)
    x[:, 5] = 2.0
    rows = spark.createDataFrame([(r.tolist(), float(t)) for r, t in zip(x, y)], "v array<double>, y double")
    df = rows.select(*[F.col("v")[i].alias(f"c{i}") for i in range(n)], "y").limit(60)
    chosen = FeatureSelector(method="correlation", label="y", n_features=1).fit(df).selected_features
    assert chosen == ["c17"]
    got = products.correlations_with(df, [f"c{i}" for i in range(20)], "y")
    assert all(abs(got[f"c{i}"] - np.corrcoef(x[:, i], y)[0, 1]) < 1e-9 for i in range(20) if i != 5) and np.isnan(got["c5"])


def test_variances(numbers):
    df, x, _, names = numbers
    got = products.sample_variances(df, names)
    want = [np.nanvar(x[:, i], ddof=1) for i in range(7)]
    assert np.allclose([got[c] for c in names], want, rtol=1e-6)
    assert np.isnan(list(products.sample_variances(df.limit(0), names[:1]).values())).all()


@pytest.mark.parametrize("kind,params", [("linear", {}), ("ridge", {"alpha": 30.0}), ("lasso", {"alpha": 0.3}), ("elasticnet", {"alpha": 0.5, "l1_ratio": 0.3})])
def test_fits_equal_those_over_the_rows(numbers, kind, params):
    df, _, _, _ = numbers
    features = ["c0", "c1", "c2", "c3", "c6"]
    folded = df.withColumn("__fold", fold_of("id", 3)).filter("y is not null")
    parts = gram.fold_grams(folded, features, "y", "__fold")
    fit = gram.solve(parts[0] + parts[2], kind, params)
    model = model_by_name(kind, **params).fit(folded.filter("__fold <> 1"), features, "y")
    both = model.predict(fit.transform(folded).withColumnRenamed("__prediction", "g"), "p").toPandas()
    assert np.allclose(both["p"], both["g"], atol=2e-3)
    mse, spread = gram.squared_errors(parts[1], fit)
    own = both[both["__fold"] == 1]
    assert mse == pytest.approx(np.mean((own["y"] - own["g"]) ** 2), rel=1e-6)
    assert spread == pytest.approx(own["y"].var(ddof=0), rel=1e-6)


def test_search_reads_the_rows_once(numbers):
    df, _, _, _ = numbers
    config = SearchConfig({"alpha": [0.1, 10.0, 1000.0]}, cv_folds=4, scoring="r2")
    features = ["c0", "c1", "c2"]
    fast = Search(config, "grid")
    scores = fast.run(model_by_name("ridge"), df.dropna(), features, "y", key="id").trials().collect()
    assert fast.splits is not None and len(fast.splits) == 4
    for trial in scores:
        folds = df.dropna().withColumn("__fold", fold_of("id", 4, config.random_state))
        own = []
        for k in range(4):
            model = model_by_name("ridge", alpha=float(trial.params["alpha"])).fit(folds.filter(F.col("__fold") != k), features, "y")
            pdf = model.predict(folds.filter(F.col("__fold") == k), "p").toPandas()
            own.append(1 - ((pdf["y"] - pdf["p"]) ** 2).sum() / ((pdf["y"] - pdf["y"].mean()) ** 2).sum())
        assert trial.score == pytest.approx(np.mean(own), abs=1e-5)
    gappy = Search(config, "grid")
    gappy.run(model_by_name("lasso"), df.fillna(0.0, ["c5"]).dropna(subset=["y"]), ["c0", "c5"], "y", key="id")
    assert gappy.splits is not None
    assert gram.fold_grams(df, ["c5"], "y") is None  # missing features
    assert gram.fold_grams(df.limit(0), ["c1"], "y") is None

"""The forms for large or skewed data give what the plain form gives."""

import time
from unittest import mock

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabloom.operators.blend import rank_average
from tabloom.operators.categories import CategoryTable
from tabloom.operators.encode import CategoricalEncoder, out_of_fold_target
from tabloom.operators.features import CategoryFeatures, GroupAggregateFeatures, TargetEncodingFeatures
from tabloom.operators.lookup import lookup_join
from tabloom.operators.rank import auc, average_rank, number_rows, number_values, number_within, running_max
from tabloom.operators.split import fold_of, is_validation, stratified_flag, stratified_folds
from tabloom.operators.stats import exact_quantiles, hot_keys
from tabloom.operators.windows import lag_features, rolling_range, rolling_rows
from tabloom.plans.chain import Chain

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows; one key and one value hold a third of them."""
    rng = np.random.default_rng(1)
    n = 3000
    key = np.where(np.arange(n) % 3 == 0, "hot", [f"k{i}" for i in rng.integers(0, 700, n)])
    value = np.where(np.arange(n) % 3 == 1, 5.0, np.round(rng.normal(0, 10, n), 2))
    frame = pd.DataFrame({"id": np.arange(n), "key": key, "value": value, "y": rng.integers(0, 2, n)})
    return spark.createDataFrame(frame).repartition(7).persist(), frame


@pytest.mark.parametrize("max_values", [500_000, 10])
def test_quantiles(skewed, max_values):
    df, frame = skewed
    probabilities = [0, 0.01, 0.25, 0.5, 0.75, 0.9, 0.999, 1]
    found = exact_quantiles(df, ["value", "id"], probabilities, max_values=max_values, sample=200, accuracy=50)
    for c in ("value", "id"):
        assert np.allclose(found[c], frame[c].quantile(probabilities), rtol=0, atol=1e-9)


def test_quantile_search_narrows(spark, monkeypatch):
    """Rounds of narrowing on more values than may be sorted at the end."""
    monkeypatch.setattr("tabloom.operators.stats.MIN_SORTED", 50)
    values = spark.range(40_000).select((F.pmod(F.xxhash64("id"), F.lit(100_003)) / 7).alias("v"))
    expected = values.toPandas()["v"].quantile([0.1, 0.5, 0.99])
    found = exact_quantiles(values, ["v"], [0.1, 0.5, 0.99], max_values=1, sample=300, accuracy=20)["v"]
    assert np.allclose(found, expected)


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.none(), st.floats(-50, 50, width=16), st.just(float("nan"))), min_size=1, max_size=60))
def test_quantiles_of_anything(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    held = pd.Series([v for v in values if v is not None], dtype="float64")
    with mock.patch("tabloom.operators.stats.MIN_SORTED", 2):
        found = exact_quantiles(df, ["v"], [0.25, 0.5], max_values=1, sample=3, accuracy=4)["v"]
    if held.notna().any():
        assert np.allclose(found, held.quantile([0.25, 0.5]))
    else:
        assert found == [None, None]


@pytest.mark.parametrize("range_rows", [500_000, 50])
def test_average_rank(skewed, range_rows):
    df, frame = skewed
    out = average_rank(df, "value", "r", range_rows).toPandas().sort_values("id")
    assert len(out) == len(frame)
    assert (out["r"].to_numpy() == frame["value"].rank(method="average").to_numpy()).all()


def test_average_rank_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 20.0), (4, 30.0), (5, None)], "id int, v double")
    out = {r["id"]: r["r"] for r in average_rank(df, "v", "r").collect()}
    assert out == {1: 1.0, 2: 2.5, 3: 2.5, 4: 4.0, 5: None}


@pytest.mark.parametrize("range_rows", [500_000, 50])
def test_auc(skewed, range_rows):
    df, frame = skewed
    ranks = frame["value"].rank()
    pos = frame["y"].sum()
    neg = len(frame) - pos
    expected = (ranks[frame["y"] == 1].sum() - pos * (pos + 1) / 2) / (pos * neg)
    assert auc(df, "y", "value", range_rows).first()["auc"] == pytest.approx(expected, abs=1e-12)


def test_number_rows(skewed):
    df, frame = skewed
    out = number_rows(df, "id", "n", range_rows=100).toPandas().sort_values("id")
    assert (out["n"].to_numpy() == np.arange(len(frame))).all()


def test_number_values_beyond_one_window(spark, skewed):
    df, frame = skewed
    out = number_values(df.select("key").distinct(), "key", "n", small=5).toPandas().sort_values("n")
    assert out["key"].tolist() == sorted(frame["key"].unique())
    assert out["n"].tolist() == list(range(len(out)))


@pytest.mark.parametrize("range_rows", [500_000, 20])
def test_number_within_is_row_number(skewed, range_rows):
    df, _ = skewed
    order = F.pmod(F.xxhash64("id"), F.lit(1 << 28))
    out = number_within(df, ["key"], order, "id", "n", range_rows)
    plain = df.withColumn("m", F.row_number().over(Window.partitionBy("key").orderBy(order, "id")))
    assert out.join(plain, "id").filter("n <> m").count() == 0
    assert out.count() == df.count()


def test_running_max(skewed):
    df, frame = skewed
    for exclusive in (False, True):
        out = running_max(df, [], "id", "value", "m", span=100, exclusive=exclusive).toPandas().sort_values("id")
        expected = frame["value"].cummax()
        expected = expected.shift(1) if exclusive else expected
        assert np.allclose(out["m"], expected, equal_nan=True)


def test_hot_keys(skewed):
    df, _ = skewed
    assert hot_keys(df, "key", 500) == ["hot"]


def test_salted_lookup(spark, skewed):
    df, frame = skewed
    table = df.groupBy("key").agg(F.sum("value").alias("s"))
    small = lookup_join(df, table, ["key"], rows=10)
    large = lookup_join(df, table, ["key"], rows=10**9, hot=["hot"], salts=8)
    assert large.count() == len(frame)
    assert large.join(small.select("id", F.col("s").alias("t")), "id").filter("abs(s - t) > 1e-9").count() == 0
    spread = large.filter("key = 'hot'").select("id").count()
    assert spread == (frame["key"] == "hot").sum()


def test_lookup_defaults(spark):
    df = spark.createDataFrame([("a",), ("zz",), (None,)], "k string")
    table = spark.createDataFrame([("a", 1)], "k string, v int")
    out = {r["k"]: r["v"] for r in lookup_join(df, table, ["k"], {"v": -1}).collect()}
    assert out == {"a": 1, "zz": -1, None: -1}


@pytest.mark.parametrize("step", [
    lambda n: CategoricalEncoder(method="label", max_local=n, columns=["key"]),
    lambda n: CategoricalEncoder(method="target", label="y", max_local=n, columns=["key"]),
    lambda n: CategoryFeatures(columns=["key"], max_local=n),
    lambda n: GroupAggregateFeatures(categories=["key"], columns=["value"], max_local=n),
    lambda n: TargetEncodingFeatures(columns=["key"], label="y", max_local=n),
])
@pytest.mark.parametrize("broadcast", [True, False])
def test_stored_categories_equal_local_ones(skewed, step, broadcast, monkeypatch):
    """More categories than the model may hold go to a table in the shared folder."""
    df, _ = skewed
    other = df.withColumn("key", F.when(F.col("id") % 11 == 0, "never seen").otherwise(F.col("key")))
    local = step(20_000).fit(df).transform(other).toPandas().sort_values("id").reset_index(drop=True)
    if not broadcast:
        monkeypatch.setattr("tabloom.operators.lookup.BROADCAST_ROWS", 5)
    model = step(10).fit(df)
    held = model.fitted["table"]["columns"]["key"]
    assert "rows" not in held and "hot" in held["hot"]
    stored = model.transform(other).toPandas().sort_values("id").reset_index(drop=True)
    pd.testing.assert_frame_equal(local, stored[local.columns])


def test_one_hot_vector_beyond_the_cap(skewed):
    df, frame = skewed
    step = CategoricalEncoder(method="onehot", columns=["key"], max_columns=5)
    out = step.fit(df).transform(df)
    assert "key" not in out.columns and "key_onehot" in out.columns
    row = out.select("key_onehot").first()[0]
    assert row.size == frame["key"].nunique() and row.numNonzeros() == 1
    unknown = step.fit(df).transform(df.limit(3).withColumn("key", F.lit("?"))).select("key_onehot").first()[0]
    assert unknown.numNonzeros() == 0


def test_out_of_fold_target(skewed):
    df, frame = skewed
    folds = {r["id"]: r["f"] for r in df.select("id", fold_of("id").alias("f")).collect()}
    frame = frame.assign(f=frame["id"].map(folds))
    out = out_of_fold_target(df, "key", "y", "id", "m").toPandas().sort_values("id")
    others = [
        frame.loc[(frame["key"] == r.key) & (frame["f"] != r.f), "y"].mean() for r in frame.itertuples()
    ]
    assert np.allclose(out["m"], pd.Series(others).fillna(0.0))


@pytest.fixture(scope="module")
def timeline(spark):
    """One entity with a third of the rows, ties in time, gaps in the values."""
    rng = np.random.default_rng(3)
    n = 1500
    entity = np.where(np.arange(n) % 3 == 0, 0, rng.integers(1, 60, n))
    second = np.sort(rng.integers(0, 4000, n))
    value = [None if i % 19 == 0 else float(v) for i, v in enumerate(rng.integers(0, 1000, n))]
    rows = [(i, int(e), int(s), v) for i, (e, s, v) in enumerate(zip(entity, second, value))]
    df = spark.createDataFrame(rows, "id int, entity int, second int, value double")
    ts = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("second")).cast("timestamp_ntz")
    return df.select("id", "entity", ts.alias("ts"), "value").persist()


def _same(a, b, on="id"):
    a = a.toPandas().sort_values(on).reset_index(drop=True)
    b = b.toPandas().sort_values(on).reset_index(drop=True)
    pd.testing.assert_frame_equal(a[sorted(a.columns)], b[sorted(a.columns)], check_dtype=False, rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("chunk_rows", [3, 50])
def test_lag_of_a_hot_entity(timeline, chunk_rows):
    plain = lag_features(timeline, "entity", ["ts", "id"], ["value"], [1, 4])
    hot = lag_features(timeline, "entity", ["ts", "id"], ["value"], [1, 4], hot_rows=20, chunk_rows=chunk_rows)
    _same(plain, hot)


def test_rolling_rows_of_a_hot_entity(timeline):
    plain = rolling_rows(timeline, "entity", ["ts", "id"], ["value"], 5)
    _same(plain, rolling_rows(timeline, "entity", ["ts", "id"], ["value"], 5, hot_rows=20, chunk_rows=7))


def test_rolling_range(timeline):
    wanted = ["sum", "count", "mean", "max", "min", "std"]
    plain = rolling_range(timeline, "entity", "ts", ["value"], 120, wanted)
    hot = rolling_range(timeline, "entity", "ts", ["value"], 120, wanted, hot_rows=20)
    _same(plain, hot)
    frame = timeline.toPandas()
    row = frame[(frame["entity"] == 0)].iloc[200]
    inside = frame[(frame["entity"] == 0) & (frame["ts"] < row["ts"]) & (frame["ts"] >= row["ts"] - pd.Timedelta(seconds=120))]
    got = plain.filter(F.col("id") == int(row["id"])).first()
    assert got["value_120s_count"] == inside["value"].count()
    assert got["value_120s_mean"] == pytest.approx(inside["value"].mean())


def test_range_of_a_hot_entity_does_not_walk_its_frames(spark):
    """200,000 rows within one frame: over 60 seconds if every frame is walked."""
    df = spark.range(200_000).select("id", F.lit("a").alias("e"), F.timestamp_seconds(F.expr("id div 2")).alias("ts"), (F.col("id") % 1000).alias("v"))
    began = time.time()
    out = rolling_range(df, "e", "ts", ["v"], 1_000_000, ["sum", "count", "max"], hot_rows=10)
    n = F.expr("id div 2 * 2")  # neither the row nor its tie
    full, rest = F.floor(n / 1000), n % 1000
    total = full * 499_500 + rest * (rest - 1) / 2
    wrong = out.filter(~(F.col("v_1000000s_count") == n) | ~F.col("v_1000000s_sum").eqNullSafe(F.when(n > 0, total)) | (F.col("v_1000000s_max") != F.when(n > 1000, 999).otherwise(n - 1)))
    assert wrong.count() == 0 and out.count() == 200_000
    assert time.time() - began < 60


def test_range_of_a_hot_entity_keeps_types_ties_and_gaps(spark):
    rows = [(i, i % 3 or None, -40 + 7 * (i // 2) + 900 * (i > 150), float("nan") if i % 11 == 0 else None if i % 7 == 0 else 1e15 if i % 50 == 49 else i % 13 / 8) for i in range(240)]
    df = spark.createDataFrame(rows, "id int, e int, at int, v double").select(
        "id", "e", F.timestamp_seconds("at").alias("ts"), "v", F.col("v").cast("float").alias("f"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("i"),
        (F.col("id") / 4).cast("decimal(12,3)").alias("d"),
    )
    wanted = ["sum", "count", "mean", "max", "min", "std"]
    for seconds in (1, 50, 5000):
        plain = rolling_range(df, "e", "ts", ["v", "f", "i", "d"], seconds, wanted)
        hot = rolling_range(df, "e", "ts", ["v", "f", "i", "d"], seconds, wanted, hot_rows=10)
        assert [(f.name, f.dataType) for f in hot.schema] == [(f.name, f.dataType) for f in plain.schema]
        want = {r.id: r for r in plain.collect()}
        for r in hot.collect():
            for name in hot.columns[7:]:
                a, b = r[name], want[r.id][name]
                assert (a is None) == (b is None) and (a is None or float(a) == pytest.approx(float(b), rel=1e-9, abs=1e-9)), (name, r.id)


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_partitioning_does_not_matter(skewed, parts):
    df, _ = skewed
    again = df.repartition(parts)
    for make in (
        lambda d: d.select("id", is_validation("id").alias("v")),
        lambda d: stratified_flag(d.select("id", "y"), "y", "id", to="v"),
        lambda d: stratified_folds(d.select("id", "y"), "y", "id", to="v"),
    ):
        assert make(df).exceptAll(make(again)).count() == 0


def test_stratified_shares_are_exact(skewed):
    df, frame = skewed
    out = stratified_flag(df, "key", "id").groupBy("key").agg(F.count_if("is_validation").alias("n")).toPandas()
    expected = np.ceil(frame["key"].value_counts() * 0.2)
    assert (out.set_index("key")["n"] == expected.reindex(out["key"]).to_numpy()).all()


def test_category_table_counts_missing(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    table = CategoryTable.build(df, ["k"], {"n": F.count(F.lit(1))})
    assert table["columns"]["k"]["rows"] == [["a", 1], ["missing", 2]]


def test_missing_entity_can_be_hot(spark):
    rows = [(i, None if i % 2 else "a", i * 10, float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, entity string, at int, value double").withColumn("ts", F.timestamp_seconds("at"))
    assert sorted(hot_keys(df, "entity", 50), key=str) == [None, "a"]
    plain = lag_features(df, "entity", ["ts"], ["value"], [2])
    _same(plain, lag_features(df, "entity", ["ts"], ["value"], [2], hot_rows=50, chunk_rows=9))
    plain = rolling_range(df, "entity", "ts", ["value"], 70, ["sum", "std"])
    _same(plain, rolling_range(df, "entity", "ts", ["value"], 70, ["sum", "std"], hot_rows=50))


def test_rank_blend_grows_linearly(spark):
    df = spark.range(60).select("id", *[((F.col("id") * (k + 3)) % 17).cast("double").alias(f"m{k}") for k in range(9)])

    def scans(n):
        plan = rank_average(df, [f"m{k}" for k in range(n)], "r")._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Range (")

    assert scans(9) <= 9 * scans(1)


def test_out_of_fold_table_knows_its_size(skewed):
    df = skewed[0].withColumn("fold", F.col("id") % 4)
    table = CategoryTable.build(df, ["key"], {"s": F.sum("y")}, max_local=3, extra_keys=["fold"])
    entries = df.select("key", "fold").distinct().count()
    assert CategoryTable.table(df.sparkSession, table, "key", {})[1] == entries


def test_saved_chain_holds_its_tables(spark, skewed, tmp_path):
    df, _ = skewed
    chain = Chain([("codes", CategoricalEncoder(columns=["key"], max_local=3))], label="y", key="id").fit(df)
    want = sorted(map(tuple, chain.transform(df).collect()))
    chain.save(str(tmp_path / "chain"))
    stored = chain.model.stages[0].fitted["table"]["columns"]["key"]["path"]
    again = Chain([]).load(str(tmp_path / "chain"))
    assert again.model.stages[0].fitted["table"]["columns"]["key"]["path"] != stored
    assert sorted(map(tuple, again.transform(df).collect())) == want

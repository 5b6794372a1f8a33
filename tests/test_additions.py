"""Exact typed ranks, spans by rows, aligning many tables, a committed log, cancelled trials, wide one-hot."""

import decimal
import random
import threading
import time
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators.encode import CategoricalEncoder
from tabloom.operators.lookup import align_on_key, missing_keys
from tabloom.operators.rank import average_rank, running_max
from tabloom.operators.tracking import latest_results
from tabloom.plans.models import TabularModel, model_config
from tabloom.plans.search import Search, SearchConfig
from tabloom.sources.results import append_results, read_log


@pytest.mark.parametrize("kind,make", [
    ("long", lambda i: 2**53 + i), ("decimal(30,3)", lambda i: decimal.Decimal(10**20 * 1000 + i) / 1000), ("string", lambda i: f"key{i:05d}"),
])
def test_ranks_of_values_that_doubles_cannot_tell_apart(spark, kind, make):
    rng = random.Random(1)
    picks = [rng.randrange(60) if i % 3 else 7 for i in range(300)] + [None] * 4
    df = spark.createDataFrame([(i, None if p is None else make(p)) for i, p in enumerate(picks)], f"id int, v {kind}")
    got = {r.id: r["rank"] for r in average_rank(df, "v", "rank").collect()}
    known = sorted(p for p in picks if p is not None)
    for i, p in enumerate(picks):
        want = None if p is None else known.index(p) + (known.count(p) + 1) / 2
        assert got[i] == want


@pytest.mark.parametrize("exclusive", [False, True])
def test_running_maximum_in_spans_of_rows(spark, exclusive):
    rng = np.random.default_rng(2)
    rows = [(int(g), int(t), float(v)) for g, t, v in zip(rng.integers(0, 3, 600), rng.permutation(600) * 10**9, rng.normal(size=600))]
    df = spark.createDataFrame(rows, "g int, t long, v double")
    got = {(r.g, r.t): r.m for r in running_max(df, ["g"], "t", "v", "m", exclusive=exclusive, range_rows=50).collect()}
    best: dict = {}
    for g, t, v in sorted(rows, key=lambda r: r[1]):
        before = best.get(g)
        best[g] = v if before is None else max(before, v)
        assert got[g, t] == (before if exclusive else best[g])


def test_fifty_tables_in_one_shuffle(spark):
    tables = [spark.range(20 + i % 3).select(F.when(F.col("id") != 19, F.col("id")).alias("k"), (F.col("id") * i).alias(f"m{i}")) for i in range(50)]
    out = align_on_key(tables, "k")
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert out.columns == ["k", *[f"m{i}" for i in range(50)]]
    assert {tuple(r) for r in out.collect()} == {(k, *[k * i for i in range(50)]) for k in range(19)}
    gaps = {r.k: r.missing for r in missing_keys({f"m{i}": t for i, t in enumerate(tables)}, "k").collect()}
    assert gaps == {20: sorted(f"m{i}" for i in range(0, 50, 3)), 21: sorted(f"m{i}" for i in range(50) if i % 3 < 2)}
    with pytest.raises(ValueError, match="m1"):
        align_on_key([tables[1], tables[1]], "k")


def test_log_of_several_writers_and_repeated_appends(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = lambda score: spark.createDataFrame([(datetime(2024, 1, 1), "m", score)], "timestamp timestamp, model string, rmse double")
    assert append_results(rows(1.0), log, token="first") == 1
    assert append_results(rows(1.0), log, token="first") == 1  # said again, not written again
    threads = [threading.Thread(target=lambda k=k: append_results(rows(2.0 + k), log)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    found = read_log(spark, log).collect()
    assert sorted(r.seq for r in found) == [1, 2, 3, 4, 5] and sorted(r.rmse for r in found) == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert latest_results(read_log(spark, log)).first()["rmse"] == 1.0  # of one second the first one written counts


class Slow(TabularModel):
    """Its fit is a Spark job that takes as long as ``alpha`` says."""

    def fit(self, df, features, label, validation=None):
        wait = float(self.config.params["alpha"])
        df.repartition(1).select(F.udf(lambda v: time.sleep(wait) or 1.0, "double")("x").alias("w")).limit(1).agg(F.sum("w")).collect()
        self.mean = 0.0
        return self

    def predict(self, df, to=None):
        return df.withColumn(to, F.lit(0.0))


def test_slow_trials_are_cancelled_at_the_deadline(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0)], "id int, x double, y double")
    search = Search(SearchConfig({"alpha": [0.0, 60.0, 0.1]}, timeout=15, scoring="neg_mean_absolute_error"), "grid")
    config = model_config("ridge")
    config.params["alpha"] = 0.0
    started = time.time()
    result = search.run(Slow(config), df, ["x"], "y", df)
    assert time.time() - started < 50
    assert {float(t["params"]["alpha"]) for t in search.history} == {0.0, 0.1}
    assert [r.error for r in result.failed().collect()] == ["TimeoutError: cancelled at the deadline"]
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()


def test_wide_one_hot_is_a_sparse_vector(spark):
    df = spark.createDataFrame([(i, f"k{i % 9}" if i % 10 else None) for i in range(90)], "id int, k string")
    out = CategoricalEncoder(key="id", method="onehot", max_local=4).fit(df).transform(df)
    assert out.columns == ["id", "k_onehot"]
    vectors = {r.id: r.k_onehot for r in out.collect()}
    assert all(v.size == 10 and v.numNonzeros() <= 1 for v in vectors.values())
    assert len({tuple(v.indices) for v in vectors.values()}) == 10


def test_many_hot_entities_make_no_larger_plan(spark):
    from tabloom.operators.windows import lag_features, rolling_range

    rows = [(None if i % 40 == 3 else i % 40, i, float(i * 7 % 31)) for i in range(1200)]
    df = spark.createDataFrame(rows, "e int, t long, v double")
    sizes = set()
    for hot in (10, 29):
        got = lag_features(df if hot == 10 else df.where("e = 5 or e < 3"), "e", ["t"], ["v"], (1, 2), hot_rows=hot, chunk_rows=4)
        sizes.add(len(got._jdf.queryExecution().optimizedPlan().toString().splitlines()))
        seen: dict = {}
        for r in sorted(got.collect(), key=lambda r: r.t):
            before = seen.setdefault(r.e, [])
            assert (r.v_lag_1, r.v_lag_2) == (before[-1] if before else None, before[-2] if len(before) > 1 else None)
            before.append(r.v)
    assert max(sizes) - min(sizes) <= 4
    stamped = df.select("e", F.timestamp_seconds("t").alias("ts"), "v")
    plain = rolling_range(stamped, "e", "ts", ["v"], 100, ("sum", "count"))
    cut = rolling_range(stamped, "e", "ts", ["v"], 100, ("sum", "count"), hot_rows=10)
    assert plain.exceptAll(cut).count() == 0 and plain.count() == cut.count() == 1200

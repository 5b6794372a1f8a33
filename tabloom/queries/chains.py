"""Preprocessing chains: fitted on the training part, applied to every row."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tabloom.operators.split import train_validation
from tabloom.plans.chain import Chain, FunctionStep, Preprocessor, default_steps, quick_preprocess
from tabloom.plans.presets import preset
from tabloom.queries.common import GAPPY, VALIDATION, gappy_orders, query, rnd, sql_rnd
from tabloom.session import scratch_path

KEY = "o_orderkey"


def _rows(spark, folder):
    return gappy_orders(spark, folder)


def _with_label(spark, folder):
    return _rows(spark, folder).withColumn("y", (F.col(KEY) % 3 == 0).cast("int"))


def _rounded(df, digits=6):
    return df.select(*[
        c if c in (KEY, "y", "part") else rnd(F.col(c).cast("double"), digits).alias(c) for c in df.columns
    ])


def _sql_chain(
    impute: str = "avg(x)", clip: tuple | None = ("iqr", 1.5), encode: str = "label", scale: str | None = "standard",
    columns: str = "o_orderkey, x, g, c, s", where: str = "", digits: int = 6,
) -> str:
    """The chain in SQL, one common table per fitted step."""
    numbers = ["x", "c"]
    steps = [
        GAPPY,
        f"flagged AS (SELECT *, {VALIDATION} AS held, CAST(o_orderkey % 3 = 0 AS INT) AS y FROM gappy)",
        f"fill AS (SELECT {impute} AS fx, (SELECT g FROM flagged WHERE NOT held AND g IS NOT NULL GROUP BY g ORDER BY count(*) DESC, g LIMIT 1) AS fg FROM flagged WHERE NOT held)",
        "filled AS (SELECT o_orderkey, coalesce(x, fx) AS x, coalesce(g, fg) AS g, c, s, y, held FROM flagged, fill)",
    ]
    if clip and clip[0] == "iqr":
        bounds = ", ".join(
            f"quantile_cont({n}, 0.25) - {clip[1]} * (quantile_cont({n}, 0.75) - quantile_cont({n}, 0.25)) AS {n}_lo, "
            f"quantile_cont({n}, 0.75) + {clip[1]} * (quantile_cont({n}, 0.75) - quantile_cont({n}, 0.25)) AS {n}_hi"
            for n in numbers)
    elif clip:
        bounds = ", ".join(
            f"avg({n}) - {clip[1]} * stddev_samp({n}) AS {n}_lo, avg({n}) + {clip[1]} * stddev_samp({n}) AS {n}_hi" for n in numbers)
    else:
        bounds = ", ".join(f"min(-1e18) AS {n}_lo, max(1e18) AS {n}_hi" for n in numbers)
    steps += [
        f"lims AS (SELECT {bounds} FROM filled WHERE NOT held)",
        "clipped AS (SELECT o_orderkey, least(greatest(x, x_lo), x_hi) AS x, g, least(greatest(c, c_lo), c_hi) AS c, s, y, held FROM filled, lims)",
    ]
    for n in ("g", "s"):
        code = "row_number() OVER (ORDER BY k) - 1" if encode == "label" else "m"
        steps.append(f"codes_{n} AS (SELECT k, {code} AS v FROM (SELECT {n} AS k, avg(y) AS m FROM clipped WHERE NOT held GROUP BY {n}))")
    steps.append(
        "coded AS (SELECT o_orderkey, x, a.v AS g, c, b.v AS s, y, held FROM clipped JOIN codes_g a ON a.k = g JOIN codes_s b ON b.k = s)")
    every = ["x", "g", "c", "s"]
    if scale == "standard":
        centres = ", ".join(f"avg({n}) AS {n}_a, stddev_pop({n}) AS {n}_b" for n in every)
    elif scale == "minmax":
        centres = ", ".join(f"min({n}) AS {n}_a, max({n}) - min({n}) AS {n}_b" for n in every)
    else:
        centres = ", ".join(f"0 AS {n}_a, 1 AS {n}_b" for n in every) + ", count(*) AS all_rows"
    steps.append(f"centres AS (SELECT {centres} FROM coded WHERE NOT held)")
    out = ", ".join(f"{sql_rnd(f'({n} - {n}_a) / {n}_b', digits)} AS {n}" for n in every)
    return f"WITH {', '.join(steps)}, final AS (SELECT o_orderkey, {out}, y, held FROM coded, centres) SELECT {columns} FROM final {where}"


@query("preprocess_default", _sql_chain())
def default_chain(spark, folder):
    rows = _rows(spark, folder)
    train, _ = train_validation(rows, KEY)
    return _rounded(Chain(key=KEY).fit(train).transform(rows))


@query("preprocess_persist", _sql_chain())
def saved_chain(spark, folder):
    rows = _rows(spark, folder)
    train, _ = train_validation(rows, KEY)
    path = scratch_path(spark, "chain")
    Chain(key=KEY).fit(train).save(path)
    return _rounded(Chain(key=KEY).load(path).transform(rows))


@query("preprocess_edit", _sql_chain(clip=None, scale="minmax"))
def edited_chain(spark, folder):
    rows = _rows(spark, folder)
    train, _ = train_validation(rows, KEY)
    chain = Chain(default_steps(), key=KEY).remove_step("outlier_handler").remove_step("feature_selector")
    chain.add_step("tidy", FunctionStep(lambda df: df.withColumn("g", F.trim("g"))), position=0)
    chain.set_params(numeric_scaler__method="minmax")
    return _rounded(chain.fit(train).transform(rows))


@query("preprocess_config", _sql_chain(impute="quantile_cont(x, 0.5)", clip=("zscore", 1.0), scale=None, digits=4))
def configured_chain(spark, folder):
    rows = _rows(spark, folder)
    train, _ = train_validation(rows, KEY)
    config = {
        "numeric_impute_strategy": "median", "outlier_method": "zscore", "outlier_threshold": 1.0, "scale_numeric": False,
    }
    return _rounded(Chain(key=KEY, config=config).fit(train).transform(rows), 4)


@query("preprocess_train_test", _sql_chain(where="WHERE held"))
def train_test(spark, folder):
    preprocessor = Preprocessor(key=KEY)
    train, test = train_validation(_rows(spark, folder), KEY)
    return _rounded(preprocessor.process_train_test(train, test)[1])


@query("preprocess_quick", _sql_chain(columns="o_orderkey, y, x, g, c, s, CASE WHEN held THEN 'test' ELSE 'train' END AS part"))
def quick(spark, folder):
    done = quick_preprocess(_with_label(spark, folder), "y", KEY)
    parts = [_rounded(done[p]).withColumn("part", F.lit(p)) for p in ("train", "test")]
    return parts[0].unionByName(parts[1])


@query("preset_regression", _sql_chain(clip=("iqr", 2.0)))
def regression_preset(spark, folder):
    rows = _rows(spark, folder)
    train, _ = train_validation(rows, KEY)
    return _rounded(Chain(key=KEY, config=preset("regression").preprocessing).fit(train).transform(rows))


@query("preset_classification", _sql_chain(
    clip=None, encode="target", columns="o_orderkey, y, x, g, c, s", digits=5))
def classification_preset(spark, folder):
    rows = _with_label(spark, folder)
    train, _ = train_validation(rows, KEY)
    chain = Chain(key=KEY, label="y", config=preset("classification").preprocessing)
    return _rounded(chain.fit(train).transform(rows), 5)


@query("custom_step", f"""
    WITH {GAPPY}, m AS (SELECT avg(x) AS a FROM gappy)
    SELECT o_orderkey, {sql_rnd('coalesce(x, a) / 1000 + c', 5)} AS mixed, upper(s) || '!' AS shout FROM gappy, m""")
def custom(spark, folder):
    """A step in Python: batches through Arrow."""
    from tabloom.operators.impute import Imputer

    @F.pandas_udf("double")
    def mix(x: pd.Series, c: pd.Series) -> pd.Series:
        return x / 1000 + c

    def shout(batches):
        for batch in batches:
            yield batch.assign(shout=batch["s"].str.upper() + "!").drop(columns=["s"])

    def step(df):
        mixed = df.select(KEY, mix("x", F.col("c").cast("double")).alias("mixed"), "s")
        return mixed.mapInPandas(shout, f"{KEY} bigint, mixed double, shout string")

    rows = _rows(spark, folder).drop("g")
    chain = Chain([("fill", Imputer(numeric_cols=["x"])), ("custom", FunctionStep(step))], key=KEY)
    return chain.fit(rows).transform(rows).select(KEY, rnd("mixed", 5).alias("mixed"), "shout")


@query("split_flagged", f"SELECT o_orderkey, s, {VALIDATION} AS held FROM (WITH {GAPPY} SELECT * FROM gappy)")
def prepared(spark, folder):
    train, test = Preprocessor(key=KEY).prepare_data(_rows(spark, folder).select(KEY, "s", "x"), "x")
    both = train.withColumn("held", F.lit(False)).unionByName(test.withColumn("held", F.lit(True)))
    return both.select(KEY, "s", "held")



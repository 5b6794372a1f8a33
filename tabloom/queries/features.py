"""Feature engineering and window features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators.features import (
    CategoryFeatures,
    DatetimeFeatures,
    GroupAggregateFeatures,
    InteractionFeatures,
    NumericFeatures,
    PolynomialFeatures,
    TargetEncodingFeatures,
)
from tabloom.operators.split import train_validation
from tabloom.operators.windows import lag_features, rolling_range, rolling_rows
from tabloom.plans.feature_set import AutoFeatures, FeatureSet
from tabloom.queries.common import GAPPY, VALIDATION, gappy_orders, query, rnd, sql_hash, sql_rnd, sql_unseen, table, unseen

KEY = "o_orderkey"


def _rounded(df, *plain, digits=4, large=()):
    """Round every floating column that is not named; ``large`` products keep two digits, quotients all."""
    floats = {f.name for f in df.schema if f.dataType.simpleString() == "double"} - set(plain)
    return df.select(*[
        rnd(c, 2 if c in large else digits).alias(c) if c in floats and "_divide_" not in c else F.col(c)
        for c in df.columns
    ])


@query("feat_numeric", f"""
    SELECT c_custkey, c_acctbal, {sql_rnd('ln(1 + greatest(coalesce(b, 0), 0))')} AS b_log,
           {sql_rnd('sqrt(greatest(coalesce(b, 0), 0))')} AS b_sqrt, {sql_rnd('b * b')} AS b_square,
           {sql_rnd('abs(b)')} AS b_abs
    FROM (SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END AS b FROM customer)""")
def numeric(spark, folder):
    key = F.col("c_custkey")
    rows = table(spark, folder, "customer").select(key, "c_acctbal", F.when(key % 11 != 0, F.col("c_acctbal")).alias("b"))
    step = NumericFeatures(columns=["b"], transformations=["log", "sqrt", "square", "abs"])
    return _rounded(step.fit_transform(rows).drop("b"), "c_acctbal")


@query("feat_category_count", f"""
    WITH {GAPPY}, train AS (SELECT * FROM gappy WHERE NOT {VALIDATION}),
    applied AS (SELECT o_orderkey, {sql_unseen()} AS g FROM gappy),
    counts AS (SELECT coalesce(g, 'missing') AS v, count(*) AS n FROM train GROUP BY 1),
    total AS (SELECT count(*) AS t FROM train)
    SELECT o_orderkey, g, coalesce(n, 0) AS g_count, {sql_rnd('coalesce(n, 0) * 1.0 / t', 6)} AS g_frequency,
           CAST(coalesce(n, 0) < 10 AS INT) AS g_is_rare
    FROM applied LEFT JOIN counts ON v = coalesce(g, 'missing'), total""")
def category_count(spark, folder):
    rows = gappy_orders(spark, folder).select(KEY, "g")
    train, _ = train_validation(rows, KEY)
    out = CategoryFeatures(key=KEY).fit(train).transform(unseen(rows))
    return _rounded(out, digits=6)


@query("feat_interaction", f"""
    SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax,
           {sql_rnd('l_quantity * l_discount')} AS l_quantity_multiply_l_discount,
           {sql_rnd('l_quantity + l_discount')} AS l_quantity_add_l_discount,
           CASE WHEN l_discount = 0 THEN 0 ELSE l_quantity / l_discount END + 0.0::DOUBLE AS l_quantity_divide_l_discount,
           {sql_rnd('l_quantity * l_tax')} AS l_quantity_multiply_l_tax,
           {sql_rnd('l_quantity + l_tax')} AS l_quantity_add_l_tax,
           CASE WHEN l_tax = 0 THEN 0 ELSE l_quantity / l_tax END + 0.0::DOUBLE AS l_quantity_divide_l_tax,
           {sql_rnd('l_discount * l_tax')} AS l_discount_multiply_l_tax,
           {sql_rnd('l_discount + l_tax')} AS l_discount_add_l_tax,
           CASE WHEN l_tax = 0 THEN 0 ELSE l_discount / l_tax END + 0.0::DOUBLE AS l_discount_divide_l_tax
    FROM lineitem""")
def interaction(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    step = InteractionFeatures(columns=["l_quantity", "l_discount", "l_tax"])
    return _rounded(step.fit_transform(rows), "l_quantity", "l_discount", "l_tax")


@query("feat_interaction_cap", f"""
    SELECT p_partkey, p_size, p_retailprice, {sql_rnd('p_size * p_retailprice')} AS p_size_multiply_p_retailprice,
           {sql_rnd('p_size + p_retailprice')} AS p_size_add_p_retailprice,
           p_size / p_retailprice AS p_size_divide_p_retailprice, half
    FROM (SELECT *, p_size / 2.0 AS half FROM part)""")
def interaction_cap(spark, folder):
    rows = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice", (F.col("p_size") / 2.0).alias("half"))
    return _rounded(InteractionFeatures(key="p_partkey", max_interactions=1).fit_transform(rows), "p_retailprice", "half")


@query("feat_polynomial", f"""
    SELECT l_orderkey, l_linenumber, l_discount, l_tax, {sql_rnd('l_discount * l_discount', 6)} AS l_discount_pow2,
           {sql_rnd('l_discount * l_tax', 6)} AS l_discount_x_l_tax, {sql_rnd('l_tax * l_tax', 6)} AS l_tax_pow2,
           {sql_rnd('l_discount * l_discount * l_discount', 6)} AS l_discount_pow3,
           {sql_rnd('l_discount * l_discount * l_tax', 6)} AS l_discount_pow2_x_l_tax,
           {sql_rnd('l_discount * l_tax * l_tax', 6)} AS l_discount_x_l_tax_pow2,
           {sql_rnd('l_tax * l_tax * l_tax', 6)} AS l_tax_pow3
    FROM lineitem""")
def polynomial(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    step = PolynomialFeatures(columns=["l_discount", "l_tax"], degree=3)
    return _rounded(step.fit_transform(rows), "l_discount", "l_tax", digits=6)


@query("feat_polynomial_vector", f"""
    SELECT l_orderkey, l_linenumber, {sql_rnd('l_discount + l_discount * l_discount + l_tax + l_discount * l_tax + l_tax * l_tax', 6)} AS total
    FROM lineitem""")
def polynomial_vector(spark, folder):
    from pyspark.ml.functions import vector_to_array

    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    step = PolynomialFeatures(columns=["l_discount", "l_tax"], as_vector=True)
    total = F.aggregate(vector_to_array("polynomial"), F.lit(0.0), lambda a, b: a + b)
    return step.fit_transform(rows).select("l_orderkey", "l_linenumber", rnd(total, 6).alias("total"))


@query("feat_datetime", """
    SELECT event_id, CAST(year(ts) AS INT) AS ts_year, CAST(month(ts) AS INT) AS ts_month, CAST(day(ts) AS INT) AS ts_day,
           CAST(isodow(ts) - 1 AS INT) AS ts_dayofweek, CAST(isodow(ts) >= 6 AS INT) AS ts_is_weekend
    FROM events""")
def dates(spark, folder):
    return DatetimeFeatures().fit_transform(table(spark, folder, "events").select("event_id", "ts")).drop("ts")


@query("feat_group_agg", f"""
    WITH {GAPPY}, train AS (SELECT * FROM gappy WHERE NOT {VALIDATION}),
    applied AS (SELECT o_orderkey, x, {sql_unseen()} AS g FROM gappy),
    stats AS (SELECT coalesce(g, 'missing') AS v, avg(x) AS a, stddev_samp(x) AS s, min(x) AS lo, max(x) AS hi, count(x) AS n
              FROM train GROUP BY 1)
    SELECT o_orderkey, {sql_rnd('a')} AS g_x_mean, {sql_rnd('s')} AS g_x_std, {sql_rnd('lo')} AS g_x_min,
           {sql_rnd('hi')} AS g_x_max, coalesce(n, 0) AS g_x_count
    FROM applied LEFT JOIN stats ON v = coalesce(g, 'missing')""")
def group_aggregates(spark, folder):
    rows = gappy_orders(spark, folder).select(KEY, "x", "g")
    train, _ = train_validation(rows, KEY)
    out = GroupAggregateFeatures(key=KEY).fit(train).transform(unseen(rows))
    return _rounded(out.drop("x", "g"))


@query("feat_target_enc", f"""
    WITH {GAPPY}, train AS (SELECT *, {sql_hash('o_orderkey')} % 5 AS fold FROM gappy WHERE NOT {VALIDATION}),
    applied AS (SELECT o_orderkey, {sql_unseen()} AS g FROM gappy WHERE {VALIDATION}),
    per AS (SELECT coalesce(g, 'missing') AS v, fold, sum(x) AS s, count(x) AS n FROM train GROUP BY 1, 2),
    tot AS (SELECT v, sum(s) AS s, sum(n) AS n FROM per GROUP BY v)
    SELECT o_orderkey, {sql_rnd('(tot.s - per.s) / (tot.n - per.n)', 3)} AS g_target_enc
    FROM train JOIN per ON per.v = coalesce(g, 'missing') AND per.fold = train.fold JOIN tot ON tot.v = per.v
    UNION ALL
    SELECT o_orderkey, {sql_rnd("coalesce(s / n, (SELECT s / n FROM tot WHERE v = 'missing'), 0)", 3)}
    FROM applied LEFT JOIN tot ON v = coalesce(g, 'missing')""")
def target_encoding(spark, folder):
    rows = gappy_orders(spark, folder).select(KEY, "x", "g")
    train, validation = train_validation(rows, KEY)
    step = TargetEncodingFeatures(key=KEY, label="x")
    both = step.fit_transform(train).unionByName(step.fit(train).transform(unseen(validation)))
    return both.select(KEY, rnd("g_target_enc", 3).alias("g_target_enc"))


@query("feat_lag", """
    SELECT event_id, user_id, lag(value, 1) OVER w AS value_lag_1, lag(value, 3) OVER w AS value_lag_3
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def lags(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    return lag_features(rows, "user_id", ["ts", "event_id"], ["value"], [1, 3]).drop("ts", "value")


@query("feat_lag_hot", """
    SELECT event_id, event_type, lag(value, 1) OVER w AS value_lag_1, lag(value, 5) OVER w AS value_lag_5
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""")
def lags_hot(spark, folder):
    """Five entities hold all rows: each is cut into chunks."""
    rows = table(spark, folder, "events").select("event_id", "event_type", "ts", "value")
    out = lag_features(rows, "event_type", ["ts", "event_id"], ["value"], [1, 5], hot_rows=500, chunk_rows=500)
    return out.drop("ts", "value")


@query("feat_rolling_rows", f"""
    SELECT event_id, user_id, {sql_rnd('avg(value) OVER w')} AS value_roll3_mean,
           {sql_rnd('stddev_samp(value) OVER w')} AS value_roll3_std, min(value) OVER w + 0.0 AS value_roll3_min,
           max(value) OVER w + 0.0 AS value_roll3_max
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""")
def rolling(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    out = rolling_rows(rows, "user_id", ["ts", "event_id"], ["value"], 3).drop("ts", "value")
    return _rounded(out, "value_roll3_min", "value_roll3_max")


@query("feat_rolling_range", f"""
    SELECT event_id, user_id, {sql_rnd('avg(value) OVER w')} AS value_86400s_mean, count(value) OVER w AS value_86400s_count
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)""")
def rolling_time(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    return _rounded(rolling_range(rows, "user_id", "ts", ["value"], 86_400).drop("ts", "value"))


_ODD = """CASE WHEN event_id % 97 = 0 THEN 1e17::DOUBLE WHEN event_id % 31 = 0 THEN NULL ELSE value END"""


@query("feat_rolling_range_nan", f"""
    WITH odd AS (SELECT event_id, CASE WHEN user_id % 10 > 0 THEN user_id END AS user_id, ts, {_ODD} AS value FROM events)
    SELECT event_id, user_id, round(sum(value) OVER w / 1e6, 2) AS value_86400s_sum, count(value) OVER w AS value_86400s_count
    FROM odd
    WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)""")
def rolling_time_nan(spark, folder):
    """NaN counts as missing, a huge value stays in its own frames, and rows without entity are a hot entity."""
    event, nan = F.col("event_id"), F.lit(float("nan"))
    odd = F.when(event % 97 == 0, F.lit(1e17)).when(event % 31 == 0, nan).otherwise(F.col("value"))
    user = F.when(F.col("user_id") % 10 > 0, F.col("user_id"))
    rows = table(spark, folder, "events").select(event, user.alias("user_id"), "ts", odd.alias("value"))
    out = rolling_range(rows, "user_id", "ts", ["value"], 86_400, ["sum", "count"], hot_rows=200)
    return out.select("event_id", "user_id", F.round(F.col("value_86400s_sum") / 1e6, 2).alias("value_86400s_sum"), "value_86400s_count")


@query("feat_rolling_range_hot", f"""
    SELECT event_id, event_type, {sql_rnd('sum(value) OVER w')} AS value_86400s_sum, count(value) OVER w AS value_86400s_count,
           {sql_rnd('avg(value) OVER w')} AS value_86400s_mean, max(value) OVER w + 0.0 AS value_86400s_max
    FROM events
    WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)""")
def rolling_time_hot(spark, folder):
    """Five entities hold all rows: running sums continue over chunks of time."""
    rows = table(spark, folder, "events").select("event_id", "event_type", "ts", "value")
    out = rolling_range(
        rows, "event_type", "ts", ["value"], 86_400, ["sum", "count", "mean", "max"], hot_rows=500
    )
    return _rounded(out.drop("ts", "value"), "value_86400s_max")


@query("feat_chain", f"""
    WITH {GAPPY}, src AS (SELECT gappy.o_orderkey, x, c, g, o_orderdate AS d FROM gappy JOIN orders USING (o_orderkey)),
    counts AS (SELECT coalesce(g, 'missing') AS v, count(*) AS n FROM src GROUP BY 1)
    SELECT o_orderkey, {sql_rnd('x')} AS x, c, g, {sql_rnd('ln(1 + greatest(coalesce(x, 0), 0))')} AS x_log,
           {sql_rnd('sqrt(greatest(coalesce(x, 0), 0))')} AS x_sqrt, {sql_rnd('ln(1 + c)')} AS c_log, {sql_rnd('sqrt(c)')} AS c_sqrt,
           n AS g_count, {sql_rnd('n * 1.0 / (SELECT count(*) FROM src)')} AS g_frequency, CAST(n < 5 AS INT) AS g_is_rare,
           {sql_rnd('x * c', 2)} AS x_multiply_c, {sql_rnd('x + c')} AS x_add_c,
           CASE WHEN c = 0 AND x IS NOT NULL THEN 0 ELSE x / nullif(c, 0) END + 0.0::DOUBLE AS x_divide_c,
           {sql_rnd('x * x', 2)} AS x_pow2, {sql_rnd('x * c', 2)} AS x_x_c, {sql_rnd('c * c * 1.0', 2)} AS c_pow2,
           CAST(year(d) AS INT) AS d_year, CAST(month(d) AS INT) AS d_month, CAST(day(d) AS INT) AS d_day,
           CAST(isodow(d) - 1 AS INT) AS d_dayofweek, CAST(isodow(d) >= 6 AS INT) AS d_is_weekend
    FROM src JOIN counts ON v = coalesce(g, 'missing')""")
def feature_chain(spark, folder):
    key = F.col(KEY)
    rows = table(spark, folder, "orders").select(
        key, F.when(key % 17 != 0, F.col("o_totalprice")).alias("x"), F.col("o_custkey").alias("c"),
        F.when(key % 23 != 0, F.col("o_orderpriority")).alias("g"), F.col("o_orderdate").alias("d"),
    )
    features = (
        FeatureSet(key=KEY).add_numeric_features(["log", "sqrt"]).add_categorical_features(min_frequency=5)
        .add_interaction_features().add_polynomial_features(2).add_datetime_features()
    )
    return _rounded(features.fit_transform(rows).drop("d"), large=("x_multiply_c", "x_pow2", "x_x_c", "c_pow2"))


@query("feat_auto", f"""
    WITH {GAPPY}, counts AS (SELECT coalesce(g, 'missing') AS v, count(*) AS n, avg(x) AS m FROM gappy GROUP BY 1)
    SELECT o_orderkey, {sql_rnd('coalesce(x, 0)')} AS x, coalesce(g, 'missing') AS g,
           {sql_rnd('ln(1 + coalesce(x, 0))')} AS x_log, {sql_rnd('sqrt(coalesce(x, 0))')} AS x_sqrt,
           {sql_rnd('coalesce(x * x, 0)', 2)} AS x_square, n AS g_count,
           {sql_rnd('n * 1.0 / (SELECT count(*) FROM gappy)')} AS g_frequency, CAST(n < 10 AS INT) AS g_is_rare,
           {sql_rnd('m')} AS g_x_mean
    FROM gappy JOIN counts ON v = coalesce(g, 'missing')""")
def automatic(spark, folder):
    rows = gappy_orders(spark, folder).select(KEY, "x", "g")
    made = AutoFeatures({"aggregation_features": True}, key=KEY)
    out = made.fit(rows).transform(rows)
    return _rounded(out.drop("g_x_std", "g_x_min", "g_x_max", "g_x_count"), large=("x_square",))

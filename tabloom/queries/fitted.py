"""Fitted column transforms: imputation, clipping, encoding, scaling, selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators.encode import CategoricalEncoder, out_of_fold_target
from tabloom.operators.impute import Imputer
from tabloom.operators.ordered import ordered_means
from tabloom.operators.outliers import OutlierClipper
from tabloom.operators.scale import Scaler
from tabloom.operators.select import FeatureSelector
from tabloom.operators.split import train_validation
from tabloom.operators.stats import numeric_columns
from tabloom.queries.common import GAPPY, VALIDATION, gappy_orders, query, rnd, sql_hash, sql_rnd, sql_unseen, table, unseen

KEY = "o_orderkey"


def _impute(**settings):
    def run(spark, folder):
        rows = gappy_orders(spark, folder)
        train, _ = train_validation(rows, KEY)
        out = Imputer(key=KEY, **settings).fit(train).transform(rows)
        return out.select(KEY, rnd(F.col("x").cast("double")).alias("x"), "g")

    return run


def _sql_impute(number: str, text: str) -> str:
    return f"""
    WITH {GAPPY}, train AS (SELECT * FROM gappy WHERE NOT {VALIDATION}),
    fill AS (SELECT {number} AS fx, {text} AS fg)
    SELECT o_orderkey, {sql_rnd('coalesce(x, fx)')} AS x, coalesce(g, fg) AS g FROM gappy, fill"""


_MODE = "(SELECT g FROM train WHERE g IS NOT NULL GROUP BY g ORDER BY count(*) DESC, g LIMIT 1)"
query("impute_mean", _sql_impute("(SELECT avg(x) FROM train)", _MODE))(_impute())
query("impute_knn", _sql_impute("(SELECT avg(x) FROM train)", _MODE))(_impute(numeric_strategy="knn"))
query("impute_median", _sql_impute("(SELECT quantile_cont(x, 0.5) FROM train)", _MODE))(
    _impute(numeric_strategy="median")
)
query("impute_constant", _sql_impute("0", _MODE))(_impute(numeric_strategy="constant"))
query("impute_missing_label", _sql_impute("(SELECT avg(x) FROM train)", "'missing'"))(
    _impute(categorical_strategy="constant")
)


@query("impute_most_frequent", f"""
    WITH src AS (SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size END AS size FROM part),
    fill AS (SELECT size AS f FROM src WHERE size IS NOT NULL GROUP BY size ORDER BY count(*) DESC, size LIMIT 1)
    SELECT p_partkey, coalesce(size, f) AS size FROM src, fill""")
def most_frequent_number(spark, folder):
    rows = table(spark, folder, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 13 != 0, F.col("p_size")).alias("size")
    )
    return Imputer(key="p_partkey", numeric_strategy="most_frequent").fit(rows).transform(rows)


@query("impute_mode", f"""
    WITH src AS (SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_brand END AS brand,
                        CAST(NULL AS VARCHAR) AS nothing FROM part),
    fill AS (SELECT brand AS f FROM src WHERE brand IS NOT NULL GROUP BY brand ORDER BY count(*) DESC, brand LIMIT 1)
    SELECT p_partkey, coalesce(brand, f) AS brand, 'missing' AS nothing FROM src, fill""")
def most_frequent_text(spark, folder):
    rows = table(spark, folder, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 13 != 0, F.col("p_brand")).alias("brand"),
        F.lit(None).cast("string").alias("nothing"),
    )
    return Imputer(key="p_partkey").fit(rows).transform(rows)


@query("impute_fit_nulls_only", f"""
    SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS x FROM orders""")
def complete_at_fit(spark, folder):
    complete = table(spark, folder, "orders").select(KEY, F.col("o_totalprice").alias("x"))
    return Imputer(key=KEY).fit(complete).transform(gappy_orders(spark, folder).select(KEY, "x"))


def _fit_on_train(rows, step):
    train, _ = train_validation(rows, KEY)
    return step.fit(train).transform(rows)


def _numeric(step, digits=4):
    def run(spark, folder):
        out = _fit_on_train(gappy_orders(spark, folder).select(KEY, "x", "c"), step())
        return out.select(KEY, rnd("x", digits).alias("x"), rnd(F.col("c").cast("double"), digits).alias("c"))

    return run


def _sql_numeric(stats: str, change, digits=4) -> str:
    fits = ", ".join(stats.replace("$", c).replace("@", f"{c}_") for c in ("x", "c"))
    return f"""
    WITH {GAPPY}, fit AS (SELECT {fits} FROM gappy WHERE NOT {VALIDATION})
    SELECT o_orderkey, {sql_rnd(change('x'), digits)} AS x, {sql_rnd(change('c'), digits)} AS c FROM gappy, fit"""


def _sql_clip(low, high):
    return lambda c: f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, {low(c)}), {high(c)}) END"


query("clip_iqr", _sql_numeric(
    "quantile_cont($, 0.25) AS @q1, quantile_cont($, 0.75) AS @q3",
    _sql_clip(lambda c: f"{c}_q1 - 0.1 * ({c}_q3 - {c}_q1)", lambda c: f"{c}_q3 + 0.1 * ({c}_q3 - {c}_q1)"),
))(_numeric(lambda: OutlierClipper(key=KEY, threshold=0.1)))
query("clip_zscore", _sql_numeric(
    "avg($) AS @m, stddev_samp($) AS @s",
    _sql_clip(lambda c: f"{c}_m - 1.5 * {c}_s", lambda c: f"{c}_m + 1.5 * {c}_s"),
))(_numeric(lambda: OutlierClipper(key=KEY, method="zscore")))
query("scale_standard", _sql_numeric(
    "avg($) AS @m, stddev_pop($) AS @s", lambda c: f"({c} - {c}_m) / {c}_s", 6
))(_numeric(lambda: Scaler(key=KEY), 6))
query("scale_minmax", _sql_numeric(
    "min($) AS @l, max($) AS @h", lambda c: f"({c} - {c}_l) / ({c}_h - {c}_l)", 6
))(_numeric(lambda: Scaler(key=KEY, method="minmax"), 6))
query("scale_robust", _sql_numeric(
    "quantile_cont($, 0.25) AS @q1, median($) AS @m, quantile_cont($, 0.75) AS @q3",
    lambda c: f"({c} - {c}_m) / ({c}_q3 - {c}_q1)", 6,
))(_numeric(lambda: Scaler(key=KEY, method="robust"), 6))


def _encode(step):
    def run(spark, folder):
        rows = gappy_orders(spark, folder).select(KEY, "x", "g", "s")
        train, _ = train_validation(rows, KEY)
        return step().fit(train).transform(unseen(rows))

    return run


_TRAIN = f"{GAPPY}, train AS (SELECT * FROM gappy WHERE NOT {VALIDATION}), applied AS (SELECT o_orderkey, x, {sql_unseen()} AS g, s FROM gappy)"


def _sql_codes(c: str) -> str:
    return f"""codes_{c} AS (
        SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
        FROM (SELECT DISTINCT coalesce({c}, 'missing') AS v FROM train))"""


@query("encode_label", f"""
    WITH {_TRAIN}, {_sql_codes('g')}, {_sql_codes('s')}
    SELECT o_orderkey, coalesce(a.code, -1) AS g, coalesce(b.code, -1) AS s
    FROM applied LEFT JOIN codes_g a ON a.v = coalesce(g, 'missing') LEFT JOIN codes_s b ON b.v = coalesce(s, 'missing')""")
def labels(spark, folder):
    return _encode(lambda: CategoricalEncoder(key=KEY))(spark, folder).select(KEY, "g", "s")


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "nan"]


@query("encode_onehot", f"""
    WITH {_TRAIN}
    SELECT o_orderkey, {", ".join(
        f"CAST(g IS NOT DISTINCT FROM {'NULL' if p == 'nan' else repr(p)} AS DOUBLE) AS \"g_{p}\"" for p in _PRIORITIES)}
    FROM applied""")
def one_hot(spark, folder):
    rows = gappy_orders(spark, folder).select(KEY, "g")
    train, _ = train_validation(rows, KEY)
    return CategoricalEncoder(key=KEY, method="onehot").fit(train).transform(unseen(rows))


@query("encode_onehot_wide", """
    SELECT c_custkey, k.n AS category, CAST(c_custkey % 250 = k.n AS DOUBLE) AS flag
    FROM customer, (SELECT DISTINCT c_custkey % 250 AS n FROM customer) k WHERE c_custkey % 250 = k.n OR k.n % 50 = 0""")
def one_hot_wide(spark, folder):
    """Up to 250 categories give as many columns; the set ones and every 50th are shown."""
    rows = table(spark, folder, "customer").select("c_custkey", (F.col("c_custkey") % 250).cast("string").alias("g"))
    out = CategoricalEncoder(key="c_custkey", method="onehot").fit(rows).transform(rows)
    made = [c for c in out.columns if c != "c_custkey"]
    long = out.unpivot(["c_custkey"], made, "name", "flag").withColumn("category", F.substring("name", 3, 9).cast("bigint"))
    return long.filter("flag = 1 OR category % 50 = 0").select("c_custkey", "category", "flag")


@query("encode_missing_text", """
    WITH src AS (SELECT p_partkey, p_retailprice AS y,
                        CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN 'missing' ELSE p_brand END AS g FROM part)
    SELECT p_partkey, CAST(g IS NULL AS DOUBLE) AS g_nan, CAST(g IS NOT DISTINCT FROM 'missing' AS DOUBLE) AS g_missing,
           """ + sql_rnd("CASE WHEN g IS NULL THEN avg(y) FILTER (WHERE g = 'missing') OVER () ELSE avg(y) OVER (PARTITION BY g) END") + """ AS mean
    FROM src""")
def missing_text(spark, folder):
    """NULL next to the text 'missing': apart as flags; the mean of the text's rows as a target mean."""
    key = F.col("p_partkey")
    g = F.when(key % 5 == 0, None).when(key % 5 == 1, "missing").otherwise(F.col("p_brand"))
    rows = table(spark, folder, "part").select(key, F.col("p_retailprice").alias("y"), g.alias("g"))
    flags = CategoricalEncoder(key="p_partkey", label="y", method="onehot").fit(rows).transform(rows)
    means = CategoricalEncoder(key="p_partkey", label="y", method="target").fit(rows).transform(rows)
    return flags.select("p_partkey", "g_nan", "g_missing").join(means.select("p_partkey", rnd("g").alias("mean")), "p_partkey")


@query("encode_target", f"""
    WITH {_TRAIN}, means AS (SELECT g AS v, avg(x) AS m FROM train WHERE g IS NOT NULL GROUP BY 1)
    SELECT o_orderkey, {sql_rnd("coalesce(m, (SELECT m FROM means WHERE v = 'missing'), 0)")} AS g
    FROM applied LEFT JOIN means ON v = g""")
def target_means(spark, folder):
    rows = gappy_orders(spark, folder).select(KEY, "x", "g")
    train, _ = train_validation(rows, KEY)
    out = CategoricalEncoder(key=KEY, label="x", method="target").fit(train).transform(unseen(rows))
    return out.select(KEY, rnd("g").alias("g"))


@query("encode_target_oof", f"""
    WITH folded AS (SELECT o_orderkey, coalesce(g, 'missing') AS g, x, {sql_hash('o_orderkey')} % 5 AS fold
                    FROM (WITH {GAPPY} SELECT * FROM gappy)),
    per AS (SELECT g, fold, sum(x) AS s, count(x) AS n FROM folded GROUP BY g, fold),
    tot AS (SELECT g, sum(s) AS s, sum(n) AS n FROM per GROUP BY g)
    SELECT o_orderkey, CASE WHEN g = 'missing' THEN 0.0::DOUBLE ELSE {sql_rnd('(tot.s - per.s) / (tot.n - per.n)', 3)} END AS g_mean
    FROM folded JOIN per USING (g, fold) JOIN tot USING (g)""")
def target_means_oof(spark, folder):
    rows = gappy_orders(spark, folder)
    return out_of_fold_target(rows, "g", "x", KEY, "m").select(KEY, rnd("m", 3).alias("g_mean"))


def _part_numbers(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", "p_size", "p_retailprice", "p_brand", "p_type",
        (F.col("p_size") * 0.0 + 7).alias("flat"), (F.col("p_size") / 1000.0).alias("tiny"),
        (F.col("p_retailprice") + F.col("p_size") * F.col("p_size")).alias("target"),
    )


@query("select_variance", """
    SELECT p_partkey, p_size, p_retailprice, p_size * p_size + p_retailprice AS target, p_brand, p_type FROM part""")
def select_variance(spark, folder):
    rows = _part_numbers(spark, folder)
    return FeatureSelector(key="p_partkey", label=None).fit(rows).transform(rows)


def _sql_correlations() -> str:
    parts = [
        f"SELECT '{n}' AS feature, abs(corr({e}, p_retailprice + p_size * p_size)) AS r FROM part"
        for n, e in (("p_size", "p_size"), ("p_retailprice", "p_retailprice"), ("tiny", "p_size / 1000.0"))
    ]
    return " UNION ALL ".join(parts)


def _correlations(spark, folder, **settings):
    rows = _part_numbers(spark, folder)
    step = FeatureSelector(key="p_partkey", label="target", method="correlation", **settings)
    chosen = step.fit(rows).selected_features
    scored = dict(step.scores(rows))
    pairs = [(c, float(scored[c]), i) for i, c in enumerate(chosen) if c in scored]
    out = spark.createDataFrame(pairs, "feature string, r double, at int")
    return out.select("feature", rnd("r", 6).alias("r"))


@query("select_correlation", f"""
    SELECT feature, {sql_rnd('r', 6)} AS r FROM ({_sql_correlations()}) WHERE r > 0.5""")
def select_correlation(spark, folder):
    return _correlations(spark, folder, threshold=0.5)


@query("select_correlation_topk", f"""
    SELECT feature, {sql_rnd('r', 6)} AS r FROM ({_sql_correlations()}) WHERE feature <> 'tiny' ORDER BY r DESC LIMIT 1""")
def select_correlation_topk(spark, folder):
    rows = _part_numbers(spark, folder).drop("tiny")
    step = FeatureSelector(key="p_partkey", label="target", method="correlation", n_features=1)
    chosen = [c for c in step.fit(rows).selected_features if c in numeric_columns(rows)]
    scored = dict(step.scores(rows))
    return spark.createDataFrame([(c, scored[c]) for c in chosen], "feature string, r double").select(
        "feature", rnd("r", 6).alias("r")
    )


@query("encode_ordered", f"""
    WITH {GAPPY}, rows AS (SELECT o_orderkey, coalesce(g, 'missing') AS g, x, {sql_hash('o_orderkey')} AS h FROM gappy),
    base AS (SELECT avg(x) AS m FROM rows)
    SELECT o_orderkey, {sql_rnd('(coalesce(sum(x) OVER w, 0) + 2 * m) / (count(x) OVER w + 2)', 3)} AS g
    FROM rows, base WINDOW w AS (PARTITION BY g ORDER BY h, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def ordered_target_means(spark, folder):
    """Ordered target statistics of the fitted rows, in ranges of 2,000 rows."""
    rows = gappy_orders(spark, folder)
    prior = rows.agg(F.avg("x")).first()[0]
    made = ordered_means(rows, ["g"], "x", KEY, prior, weight=2.0, range_rows=2_000)
    return made.select(KEY, rnd("g_ordered", 3).alias("g"))

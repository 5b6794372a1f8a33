"""Projections, cleaning, validation, splits, lookups and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.functions import (
    CONDITION_RANKS,
    clean_numeric,
    clean_string,
    format_score,
    ordinal,
    run_name,
    uniform,
)
from tabloom.operators.impute import any_null, drop_target, null_profile
from tabloom.operators.lookup import align_on_key, count_shared_keys, lookup_value
from tabloom.operators.select import select_available, select_by_type
from tabloom.operators.split import fold_of, is_validation, stratified_flag, stratified_folds, train_validation
from tabloom.operators.validate import missing_columns, validate_columns, validate_xy
from tabloom.queries.common import (
    GAPPY,
    PREDICTIONS,
    VALIDATION,
    gappy_orders,
    predictions,
    query,
    rnd,
    sql_hash,
    sql_rnd,
    table,
)


@query("select_by_type", "SELECT p_partkey, p_size, p_retailprice FROM part")
def by_type(spark, folder):
    return select_by_type(table(spark, folder, "part"), "numeric")


@query("select_by_type_text", "SELECT p_name, p_brand, p_type FROM part")
def by_type_text(spark, folder):
    return select_by_type(table(spark, folder, "part"), "categorical")


@query("drop_target", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def dropped(spark, folder):
    return drop_target(drop_target(table(spark, folder, "supplier"), "s_acctbal"), "no_such_column")


@query("select_available", "SELECT p_size, p_brand, p_partkey FROM part")
def available(spark, folder):
    return select_available(table(spark, folder, "part"), ["p_size", "gone", "p_brand", "p_partkey"])


@query("clean_numeric", """
    SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS positive,
           CASE WHEN c_acctbal BETWEEN 0 AND 5000 THEN c_acctbal END AS bounded
    FROM customer""")
def cleaned_numbers(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", clean_numeric("c_acctbal").alias("positive"), clean_numeric("c_acctbal", 0, 5000).alias("bounded")
    )


@query("clean_string", "SELECT p_partkey, upper(p_name) AS name FROM part")
def cleaned_strings(spark, folder):
    padded = F.concat(F.lit(" \t "), F.col("p_name"), F.lit("\n  "))
    return table(spark, folder, "part").select("p_partkey", clean_string(padded).alias("name"))


@query("ordinal_map", """
    SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 END AS rank FROM customer""")
def ordinals(spark, folder):
    grades = F.array(*[F.lit(f" {g.capitalize()} ") for g in CONDITION_RANKS], F.lit("unknown"))
    grade = F.get(grades, (F.col("c_custkey") % 5).cast("int"))
    return table(spark, folder, "customer").select("c_custkey", ordinal(grade).alias("rank"))


@query("validate_columns", """
    SELECT 'complete' AS test, count(*) > 0 AS valid, 0 AS n_missing FROM orders
    UNION ALL SELECT 'lacking', false, 1 FROM (SELECT count(*) FROM orders)
    UNION ALL SELECT 'empty', count(*) > 0, 0 FROM (SELECT * FROM orders WHERE o_totalprice < -1e18)""")
def checked_columns(spark, folder):
    df = table(spark, folder, "orders")
    wanted = ["o_orderkey", "o_totalprice"]
    cases = [
        ("complete", df, wanted), ("lacking", df, [*wanted, "gone"]),
        ("empty", df.filter(F.col("o_totalprice") < -1e18), wanted),
    ]
    rows = [(n, validate_columns(d, w), len(missing_columns(d, w))) for n, d, w in cases]
    return spark.createDataFrame(rows, "test string, valid boolean, n_missing int")


@query("validate_xy", """
    SELECT 'aligned' AS test, count(*) > 0 AS valid FROM orders
    UNION ALL SELECT 'shorter', (SELECT count(*) FROM orders) = (SELECT count(*) FROM orders WHERE o_orderstatus = 'F')
    UNION ALL SELECT 'absent', false""")
def checked_xy(spark, folder):
    df = table(spark, folder, "orders")
    x, y = df.select("o_orderkey", "o_custkey"), df.select("o_orderkey", "o_totalprice")
    short = df.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    rows = [
        ("aligned", validate_xy(x, y, "o_orderkey")), ("shorter", validate_xy(x, short)), ("absent", validate_xy(x, None)),
    ]
    return spark.createDataFrame(rows, "test string, valid boolean")


@query("split_hash", f"SELECT o_orderkey, {VALIDATION} AS is_validation FROM orders")
def split_hash(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", is_validation("o_orderkey").alias("is_validation"))


@query("split_stratified", f"""
    SELECT o_orderkey, o_orderstatus,
           row_number() OVER (PARTITION BY o_orderstatus ORDER BY {sql_hash('o_orderkey')}, o_orderkey)
             <= ceil(count(*) OVER (PARTITION BY o_orderstatus) * 0.2) AS is_validation
    FROM orders""")
def split_stratified(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return stratified_flag(rows, "o_orderstatus", "o_orderkey")


@query("kfold_hash", f"SELECT o_orderkey, CAST({sql_hash('o_orderkey')} % 5 AS INT) AS fold FROM orders")
def kfold_hash(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", fold_of("o_orderkey").alias("fold"))


@query("kfold_stratified", f"""
    SELECT o_orderkey, o_orderstatus,
           CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {sql_hash('o_orderkey')}, o_orderkey) - 1) % 5
                AS INT) AS fold
    FROM orders""")
def kfold_stratified(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return stratified_folds(rows, "o_orderstatus", "o_orderkey")


@query("leakage_check", f"""
    SELECT count(DISTINCT o_orderkey) AS shared_keys FROM orders
    WHERE NOT {VALIDATION} AND o_orderkey IN (SELECT o_orderkey FROM orders WHERE {VALIDATION})""")
def leakage(spark, folder):
    train, validation = train_validation(table(spark, folder, "orders"), "o_orderkey")
    return count_shared_keys(train, validation, "o_orderkey")


@query("lookup_join", """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 10 WHEN '2-HIGH' THEN 8 ELSE -1 END AS weight FROM orders""")
def looked_up(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return lookup_value(rows, "o_orderpriority", {"1-URGENT": 10, "2-HIGH": 8}, -1, "weight").select("o_orderkey", "weight")


@query("align_predictions", f"""
    WITH {PREDICTIONS} SELECT o_orderkey, {sql_rnd('m1')} AS m1, {sql_rnd('m2')} AS m2 FROM pred""")
def aligned(spark, folder):
    rows = predictions(spark, folder)
    both = align_on_key([rows.select("o_orderkey", "m1"), rows.select("o_orderkey", "m2")], "o_orderkey")
    return both.select("o_orderkey", rnd("m1").alias("m1"), rnd("m2").alias("m2"))


@query("null_profile", f"""
    WITH {GAPPY}
    SELECT count(*) - count(o_orderkey) AS o_orderkey, count(*) - count(x) AS x, count(*) - count(g) AS g,
           count(*) - count(c) AS c, count(*) - count(s) AS s
    FROM gappy""")
def nulls(spark, folder):
    return null_profile(gappy_orders(spark, folder))


@query("any_null", f"WITH {GAPPY} SELECT count(*) > count(x) OR count(*) > count(g) AS has_nulls FROM gappy")
def nulls_at_all(spark, folder):
    return any_null(gappy_orders(spark, folder))


@query("format_score", "SELECT p_partkey, printf('%.4f', p_retailprice) AS four, printf('%.1f', p_size * 1.0) AS one FROM part")
def formatted(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", format_score("p_retailprice").alias("four"), format_score("p_size", 1).alias("one")
    )


@query("format_run", """
    SELECT event_id, event_type || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '.csv' AS name FROM events""")
def run_names(spark, folder):
    return table(spark, folder, "events").select("event_id", run_name("event_type", "ts", ".csv").alias("name"))


@query("uniform_draw", f"SELECT o_orderkey, {sql_rnd(sql_hash('o_orderkey', 7) + ' / 268435456.0', 9)} AS u FROM orders")
def uniform_draw(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", rnd(uniform("o_orderkey", seed=7), 9).alias("u"))

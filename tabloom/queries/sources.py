"""Sources and sinks: everything written is read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tabloom.operators.tracking import best_model, latest_results
from tabloom.operators.validate import result_flags
from tabloom.queries.common import GAPPY, PREDICTIONS, gappy_orders, predictions, query, rnd, sql_rnd, table
from tabloom.session import scratch_path
from tabloom.sources.results import (
    ResultWriter,
    append_results,
    read_log,
    save_predictions,
    summarize_result,
)
from tabloom.sources.tables import load_data, missing_as_null, read_csv, replace_table, table_exists, table_info


@query("scan_csv", """
    SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS segment,
           CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END AS balance
    FROM customer""")
def scan_csv(spark, folder):
    key = F.col("c_custkey")
    rows = table(spark, folder, "customer").select(
        key, F.when(key % 7 != 0, F.col("c_mktsegment")).alias("segment"),
        F.when(key % 11 != 0, F.col("c_acctbal")).alias("balance"),
    )
    path = scratch_path(spark, "customer-csv")
    rows.write.option("header", True).csv(path)
    return read_csv(spark, path, "c_custkey bigint, segment string, balance double")


@query("scan_csv_inferred", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_csv_inferred(spark, folder):
    path = scratch_path(spark, "supplier-csv")
    table(spark, folder, "supplier").write.option("header", True).csv(path)
    return read_csv(spark, path).select(
        F.col("s_suppkey").cast("bigint").alias("s_suppkey"), "s_name",
        F.col("s_nationkey").cast("int").alias("s_nationkey"), F.col("s_acctbal").cast("double").alias("s_acctbal"),
    )


@query("scan_table_split", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders""")
def scan_table_split(spark, folder):
    x, y = load_data(spark, f"{folder}/orders.parquet", "o_totalprice", "o_orderkey")
    return x.drop("o_orderdate").join(y, "o_orderkey")


@query("missing_as_null", f"""
    SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS x FROM orders""")
def nan_ingress(spark, folder):
    key = F.col("o_orderkey")
    rows = table(spark, folder, "orders").select(
        key, F.when(key % 17 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("x")
    )
    return missing_as_null(rows)


def _unique(name: str) -> str:
    import uuid

    return f"{name}_{uuid.uuid4().hex[:12]}"


@query("replace_table", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def replaced(spark, folder):
    name = _unique("replaced")
    replace_table(table(spark, folder, "customer").select("c_custkey"), name)
    replace_table(table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_acctbal"), name)
    return spark.table(name)


@query("table_exists", """
    SELECT 'suppliers' AS table_name, count(*) > 0 AS found FROM supplier
    UNION ALL SELECT 'no_such_table', count(*) < 0 FROM supplier""")
def exists(spark, folder):
    name = _unique("suppliers")
    replace_table(table(spark, folder, "supplier"), name)
    rows = spark.table(name).agg(F.count(F.lit(1)).alias("n"))
    found, absent = table_exists(spark, name), table_exists(spark, _unique("no_such_table"))
    return rows.select(F.explode(F.array(
        F.struct(F.lit("suppliers").alias("table_name"), F.lit(found).alias("found")),
        F.struct(F.lit("no_such_table").alias("table_name"), F.lit(absent).alias("found")),
    )).alias("t")).select("t.*")


@query("table_info", """
    SELECT 'parts' AS table_name, count(*) AS row_count, CAST(6 AS INT) AS column_count, true AS exists FROM part
    UNION ALL SELECT 'absent', 0, 0, false""")
def info(spark, folder):
    name = _unique("parts")
    replace_table(table(spark, folder, "part"), name)
    there = table_info(spark, name).withColumn("table_name", F.lit("parts"))
    return there.unionByName(table_info(spark, _unique("absent")).withColumn("table_name", F.lit("absent")))


@query("submission_csv", f"""
    WITH {PREDICTIONS}
    SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS id, {sql_rnd('m1')} AS target FROM pred""")
def submission_csv(spark, folder):
    writer = ResultWriter(scratch_path(spark, "results"))
    path = writer.write(predictions(spark, folder), "m1", order="o_orderkey")
    return writer.read(spark, path).select("id", rnd("target").alias("target"))


@query("submission_with_ids", f"""
    WITH {PREDICTIONS}
    SELECT o_orderkey AS order_id, {sql_rnd('(0.3 * m1 + 0.7 * m2)')} AS price FROM pred""")
def submission_with_ids(spark, folder):
    writer = ResultWriter(scratch_path(spark, "results"), "order_id", "price")
    path = writer.write_weighted(predictions(spark, folder), ["m1", "m2"], weights=[3, 7], ids="o_orderkey")
    return writer.read(spark, path).select("order_id", rnd("price").alias("price"))


@query("submission_multi", f"""
    WITH {PREDICTIONS}
    SELECT 'm1' AS model, o_orderkey AS id, {sql_rnd('m1')} AS target FROM pred
    UNION ALL SELECT 'm2', o_orderkey, {sql_rnd('m2')} FROM pred""")
def submission_multi(spark, folder):
    writer = ResultWriter(scratch_path(spark, "results"))
    paths = writer.write_each(predictions(spark, folder), ["m1", "m2"], ids="o_orderkey")
    parts = [
        writer.read(spark, path).select(F.lit(model).alias("model"), "id", rnd("target").alias("target"))
        for model, path in paths.items()
    ]
    return parts[0].unionByName(parts[1])


@query("save_predictions", f"""
    WITH {PREDICTIONS}
    SELECT o_orderkey, {sql_rnd('m1')} AS prediction, '2024-05-06 07:08:09' AS stamp, 'm1' AS model, '20240506_070809' AS run
    FROM pred""")
def saved_predictions(spark, folder):
    path = scratch_path(spark, "predictions")
    save_predictions(predictions(spark, folder), "m1", "m1", datetime(2024, 5, 6, 7, 8, 9), path, keys=["o_orderkey"])
    rows = spark.read.schema("o_orderkey bigint, prediction double, timestamp timestamp, model string, run string").parquet(path)
    stamp = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    return rows.select("o_orderkey", rnd("prediction").alias("prediction"), stamp.alias("stamp"), "model", "run")


def _log_rows(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderdate").cast("timestamp").alias("timestamp"), F.col("o_orderpriority").alias("model"),
        (F.col("o_totalprice") / 1000).alias("rmse"), F.col("o_orderkey").alias("seq"), "o_orderstatus",
    )


@query("result_log_append", f"""
    SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp, o_orderpriority AS model,
           {sql_rnd('o_totalprice / 1000', 6)} AS rmse
    FROM orders""")
def log_append(spark, folder):
    path, rows = scratch_path(spark, "log"), _log_rows(spark, folder)
    append_results(rows.filter("o_orderstatus = 'F'"), path)
    append_results(rows.filter("o_orderstatus <> 'F'"), path)
    log = read_log(spark, path)
    stamp = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("stamp")
    return log.select(stamp, "model", rnd("rmse", 6).alias("rmse"))


_LATEST = f"""latest AS (
    SELECT o_orderpriority AS model, o_totalprice / 1000 AS rmse, o_orderdate AS ts
    FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS rn
          FROM orders)
    WHERE rn = 1)"""


@query("latest_result", f"""
    WITH {_LATEST}
    SELECT model, {sql_rnd('rmse', 6)} AS rmse, strftime(ts, '%Y-%m-%d') AS day FROM latest""")
def latest(spark, folder):
    path = scratch_path(spark, "log")
    append_results(_log_rows(spark, folder), path)
    newest = latest_results(read_log(spark, path))
    return newest.select("model", rnd("rmse", 6).alias("rmse"), F.date_format("timestamp", "yyyy-MM-dd").alias("day"))


@query("best_model", f"""
    WITH {_LATEST}
    SELECT model, {sql_rnd('rmse', 6)} AS rmse FROM latest ORDER BY rmse, model LIMIT 1""")
def best(spark, folder):
    return best_model(_log_rows(spark, folder)).select("model", rnd("rmse", 6).alias("rmse"))


@query("model_config_json", """
    SELECT p_partkey, p_brand AS name, p_type AS model_type, p_size AS max_depth, p_retailprice / 1000 AS learning_rate
    FROM part""")
def model_config_json(spark, folder):
    params = F.struct(F.col("p_size").alias("max_depth"), (F.col("p_retailprice") / 1000).alias("learning_rate"))
    document = F.to_json(F.struct(F.col("p_brand").alias("name"), F.col("p_type").alias("model_type"), params.alias("params")))
    path = scratch_path(spark, "configs")
    table(spark, folder, "part").select("p_partkey", document.alias("config")).write.parquet(path)
    schema = "name string, model_type string, params struct<max_depth: int, learning_rate: double>"
    stored = spark.read.parquet(path).select("p_partkey", F.from_json("config", schema).alias("c"))
    return stored.select("p_partkey", "c.name", "c.model_type", "c.params.max_depth", "c.params.learning_rate")


@query("validate_submission", f"""
    WITH {GAPPY}
    SELECT 'complete' AS result, count(*) AS n_rows, true AS rows_ok, true AS columns_ok, false AS has_nulls, true AS valid FROM gappy
    UNION ALL SELECT 'gaps', count(*), true, true, count(x) < count(*), count(x) = count(*) FROM gappy
    UNION ALL SELECT 'column', count(*), true, false, count(x) < count(*), false FROM gappy
    UNION ALL SELECT 'short', count(*), count(*) = 1, true, false, false FROM gappy""")
def validated(spark, folder):
    rows = gappy_orders(spark, folder)
    n = rows.count()
    cases = {
        "complete": (rows.select("o_orderkey", "c"), n, ["o_orderkey", "c"]),
        "gaps": (rows.select("o_orderkey", "x"), n, ["o_orderkey", "x"]),
        "column": (rows.select("o_orderkey", "x"), n, ["o_orderkey", "target"]),
        "short": (rows.select("o_orderkey", "c"), 1, None),
    }
    out = None
    for name, (df, expected, columns) in cases.items():
        flags = result_flags(df, expected, columns).select(F.lit(name).alias("result"), "*")
        out = flags if out is None else out.unionByName(flags)
    return out


@query("submission_summary", f"""
    WITH {PREDICTIONS}
    SELECT count(*) AS n_rows, CAST(2 AS INT) AS n_columns, false AS has_nulls, {sql_rnd('avg(m1)')} AS mean,
           {sql_rnd('stddev_samp(m1)')} AS std, {sql_rnd('min(m1)')} AS min, {sql_rnd('max(m1)')} AS max,
           count(DISTINCT m1) AS unique_values
    FROM pred""")
def summary(spark, folder):
    out = summarize_result(predictions(spark, folder).select("o_orderkey", "m1"))
    return out.select(
        "n_rows", "n_columns", "has_nulls", *[rnd(c).alias(c) for c in ("mean", "std", "min", "max")], "unique_values"
    )

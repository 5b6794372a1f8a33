"""Result files, prediction files, score log and model settings.

Sinks write folders of part files, one task each; nothing is funnelled into a single file.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators import blend
from tabloom.operators.rank import number_rows
from tabloom.operators.stats import quoted
from tabloom.operators.validate import result_flags

ENTRY = re.compile(r"entry-(\d+)-([A-Za-z0-9]+)")
LOG_SCHEMA = "timestamp timestamp, model string, rmse double, seq bigint, row bigint"


def stamped(name: str, now: datetime | None = None) -> str:
    return f"{name}_{(now or datetime.now()).strftime('%Y%m%d_%H%M%S')}"


class ResultWriter:
    """Two-column result files ``id, target`` under ``folder``."""

    def __init__(self, folder: str, id_column: str = "id", target_column: str = "target"):
        self.folder, self.id_column, self.target_column = folder.rstrip("/"), id_column, target_column

    def _write(self, df: DataFrame, name: str) -> str:
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").option("header", True).csv(path)
        return path

    def write(
        self, df: DataFrame, prediction: str, *, ids: str | None = None, order: str | None = None,
        name: str | None = None,
    ) -> str:
        """``ids`` names the id column; without one rows get 0..n-1 in the order of ``order``."""
        return self._write(self.rows(df, prediction, ids=ids, order=order), name or stamped("submission"))

    def rows(self, df: DataFrame, prediction: str, *, ids: str | None = None, order: str | None = None) -> DataFrame:
        if ids is None:
            if order is None:
                raise ValueError("name an id column, or an order column to number the rows by")
            df, ids = number_rows(df.select(order, prediction), order, "__id"), "__id"
        return df.select(quoted(ids).alias(self.id_column), quoted(prediction).alias(self.target_column))

    def write_weighted(self, df, columns: Sequence[str], *, weights=None, ids=None, order=None, name=None) -> str:
        blended = df.withColumn("__blend", blend.weighted(columns, weights=weights))
        return self.write(blended, "__blend", ids=ids, order=order, name=name or stamped("ensemble_submission"))

    def write_geometric(self, df, columns: Sequence[str], *, ids=None, order=None, name=None) -> str:
        blended = df.withColumn("__blend", blend.geometric(columns))
        return self.write(blended, "__blend", ids=ids, order=order, name=name or stamped("geometric_mean_submission"))

    def write_rank_average(self, df, columns: Sequence[str], *, ids=None, order=None, name=None) -> str:
        blended = blend.rank_average(df, columns, "__blend")
        return self.write(blended, "__blend", ids=ids, order=order, name=name or stamped("rank_average_submission"))

    def write_each(self, df: DataFrame, columns: Sequence[str], *, ids: str, name: str | None = None) -> dict[str, str]:
        """One folder per prediction column, all written by one job over one scan."""
        rows = df.select(
            quoted(ids).alias(self.id_column),
            F.explode(F.array(*[
                F.struct(F.lit(c).alias("model"), quoted(c).cast("double").alias(self.target_column))
                for c in columns
            ])).alias("p"),
        ).select("p.model", self.id_column, f"p.{self.target_column}")
        path = f"{self.folder}/{name or stamped('submission')}"
        rows.write.mode("overwrite").partitionBy("model").option("header", True).csv(path)
        return {c: f"{path}/model={c}" for c in columns}

    def read(self, spark: SparkSession, path: str, id_type: str = "bigint", target_type: str = "double") -> DataFrame:
        schema = f"`{self.id_column}` {id_type}, `{self.target_column}` {target_type}"
        return spark.read.option("header", True).schema(schema).csv(path)


def validate_result(
    spark: SparkSession, path: str, expected_rows: int | None = None, expected_columns: Sequence[str] | None = None
) -> bool:
    """False for a wrong row count, missing columns, nulls or an unreadable file."""
    try:
        df = spark.read.option("header", True).csv(path)
        return bool(result_flags(df, expected_rows, expected_columns).first()["valid"])
    except PySparkException as e:
        if isinstance(e, AnalysisException) or any(word in str(e) for word in ("MALFORMED", "FAILED_READ_FILE", "CANNOT_READ")):
            return False
        raise


def summarize_result(df: DataFrame, path: str | None = None) -> DataFrame:
    """Shape, nulls and statistics of the second column; file size if ``path`` is given."""
    target = quoted(df.columns[1])
    nulls = F.lit(False)
    for c in df.columns:
        nulls = nulls | (F.count(quoted(c)) < F.count(F.lit(1)))
    out = df.agg(
        F.count(F.lit(1)).alias("n_rows"), nulls.alias("has_nulls"), F.avg(target).alias("mean"),
        F.stddev_samp(target).alias("std"), F.min(target).alias("min"), F.max(target).alias("max"),
        F.count_distinct(target).alias("unique_values"),
    ).withColumn("n_columns", F.lit(len(df.columns)))
    return out.withColumn("file_size_mb", F.lit(folder_bytes(df.sparkSession, path) / 1048576)) if path else out


def folder_bytes(spark: SparkSession, path: str) -> int:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.sum("length")).first()[0] or 0


def save_predictions(
    df: DataFrame, prediction: str, model: str, ts: datetime, folder: str, keys: Sequence[str] = ()
) -> str:
    """``prediction, timestamp`` rows of one run below ``model=.../run=...``, with the key columns they belong to."""
    rows = df.select(
        *[quoted(k) for k in keys], quoted(prediction).alias("prediction"), F.lit(ts).alias("timestamp"),
        F.lit(model).alias("model"), F.lit(ts.strftime("%Y%m%d_%H%M%S")).alias("run"),
    )
    rows.write.mode("append").partitionBy("model", "run").parquet(folder)
    return f"{folder}/model={model}/run={ts.strftime('%Y%m%d_%H%M%S')}"


def append_result(spark: SparkSession, log: str, model: str, score: float, ts: datetime | None = None) -> None:
    row = [((ts or datetime.now()).replace(microsecond=0), model, float(score))]
    append_results(spark.createDataFrame(row, "timestamp timestamp, model string, rmse double"), log)


def append_results(rows: DataFrame, log: str, token: str | None = None) -> int:
    """Append (timestamp, model, rmse) rows to the log folder; the number of the entry.

    Timestamps are whole seconds, so the log keeps the order of writing: entries are numbered, ``row`` is the column
    ``seq`` of ``rows`` or else the place of the row within the entry. An entry is written aside and then renamed to the
    next free number, which only one writer can do, so neither clocks nor retried tasks reorder or repeat rows. An
    append whose ``token`` is in the log already is not repeated.
    """
    spark, token = rows.sparkSession, token or uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9]+", token):
        raise ValueError("a token is made of letters and digits")
    row = F.col("seq") if "seq" in rows.columns else F.monotonically_increasing_id()
    aside = f"{log}/_aside-{uuid.uuid4().hex}"  # readers pass over names that begin with _
    rows.select("timestamp", "model", "rmse", F.lit(None).cast("bigint").alias("seq"), row.cast("bigint").alias("row")).write.parquet(aside)
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    place = hadoop.Path(log)
    files = hadoop.FileContext.getFileContext(place.getFileSystem(conf).getUri(), conf)
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    while True:
        found = [ENTRY.fullmatch(f.getPath().getName()) for f in place.getFileSystem(conf).listStatus(place)]
        entries = {m[2]: int(m[1]) for m in found if m}
        if token in entries:
            place.getFileSystem(conf).delete(hadoop.Path(aside), True)
            return entries[token]
        number = max(entries.values(), default=0) + 1
        # the number alone is what writers compete for: a folder of its own, made before the entry moves in
        claim = hadoop.Path(f"{log}/_claim-{number:012d}")
        try:
            place.getFileSystem(conf).create(claim, False).close()
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            _wait_for(place.getFileSystem(conf), place, claim, number)
            continue
        files.rename(hadoop.Path(aside), hadoop.Path(f"{log}/entry-{number:012d}-{token}"), options)
        return number


def _wait_for(system, place, claim, number: int, seconds: float = 30.0) -> None:
    """Until the writer that holds a number has moved its entry in; the claim of a writer that died is taken away."""
    until = time.time() + seconds
    while time.time() < until:
        if any(f.getPath().getName().startswith(f"entry-{number:012d}-") for f in system.listStatus(place)):
            return
        time.sleep(0.05)
    system.delete(claim, False)


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """All committed rows; ``seq`` is the number of the entry."""
    rows = spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", True).parquet(log)
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/entry-(\d+)-[A-Za-z0-9]+/", 1)
    return rows.withColumn("seq", F.coalesce(F.when(number != "", number.cast("bigint")), F.col("seq")))


def save_model_config(spark: SparkSession, config: Mapping, model: str, folder: str) -> str:
    """Settings as one JSON document, on whatever file system ``folder`` names."""
    path = f"{folder}/{model}_config"
    text = json.dumps(config, default=str, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").write.mode("overwrite").text(path)
    return path


def load_model_config(spark: SparkSession, model: str, folder: str) -> dict | None:
    """The settings, or None if the model has none."""
    from pyspark.errors import AnalysisException

    try:
        rows = spark.read.text(f"{folder}/{model}_config", wholetext=True).head(1)
    except AnalysisException:
        return None
    return json.loads(rows[0][0]) if rows else None

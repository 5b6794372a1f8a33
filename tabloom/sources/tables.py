"""CSV, parquet and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabloom.functions.columns import nan_to_null
from tabloom.operators.stats import quoted


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header; an empty cell is NULL. Without a schema one extra pass infers it."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a parquet file or folder if ``name`` is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def load_data(spark: SparkSession, name: str, target: str, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(features, target) projections of one table; the key goes into both so they can be aligned."""
    df = read_table(spark, name)
    held = [key, target] if key else [target]
    return df.drop(target), df.select(*held)


def missing_as_null(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column, as one projection."""
    return df.select(*[
        nan_to_null(quoted(f.name), f.dataType.simpleString()).alias(f.name) for f in df.schema
    ])


def replace_table(df: DataFrame, name: str, path: str | None = None) -> str:
    """Drop and create ``name`` from ``df``, in the warehouse or at ``path``. Returns where its files are."""
    spark = df.sparkSession
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return path or spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()["data_type"]


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_info(spark: SparkSession, name: str) -> DataFrame:
    """One row (table_name, row_count, column_count, exists); zeros for an absent table."""
    if not table_exists(spark, name):
        return spark.range(1).select(
            F.lit(name).alias("table_name"), F.lit(0).cast("bigint").alias("row_count"),
            F.lit(0).alias("column_count"), F.lit(False).alias("exists"),
        )
    df = spark.table(name)
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"),
        F.lit(True).alias("exists"),
    )

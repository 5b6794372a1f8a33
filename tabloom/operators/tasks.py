"""Arrow code in Spark tasks: this package reaches the executors through the shared folder."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabloom.session import scratch_path

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tabloom`` importable in tasks, once a session."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package, archive = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), io.BytesIO()
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for path in (os.path.join(folder, n) for n in names if n.endswith(".py")):
                z.write(path, os.path.relpath(path, os.path.dirname(package)))
    to = sc._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'package')}/tabloom.zip")
    out = to.getFileSystem(sc._jsc.hadoopConfiguration()).create(to)
    out.write(archive.getvalue())
    out.close()
    sc.addPyFile(to.toString())
    _shipped.add(sc.applicationId)


def in_tasks(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with the package at hand."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this session wrote."""
    sc = spark.sparkContext
    to = sc._jvm.org.apache.hadoop.fs.Path(path)
    to.getFileSystem(sc._jsc.hadoopConfiguration()).delete(to, True)

"""Per-category statistics of several columns from one grouped aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators.lookup import lookup_join
from tabloom.operators.rank import number_values
from tabloom.operators.stats import quoted
from tabloom.session import scratch_path

MISSING = "missing"
MAX_BRANCHES = 64
ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}
MAX_LOCAL = 20_000
HOT_SHARE = 1_000


class CategoryTable:
    """Category -> values for some columns.

    Up to ``MAX_LOCAL`` categories in total live as JSON in the model. More are a parquet table in
    the shared folder (one partition folder per column); only the hot categories - each above
    1/1000 of the fitted rows, so at most a thousand per column - stay with the model.
    """

    @staticmethod
    def build(
        df: DataFrame, columns: Sequence[str], aggregates: Mapping[str, Column], codes: bool = False,
        max_local: int = MAX_LOCAL, extra_keys: Sequence[str] = (), null_as: str | None = MISSING,
    ) -> dict:
        """``aggregates`` may use every column of ``df``. NULL is the category ``null_as``; with None it has no entry."""
        if not columns:
            return {"columns": {}, "names": [], "keys": []}
        pairs = F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.coalesce(quoted(c), F.lit(null_as)).alias("category"))
            for c in columns
        ]))
        keys = ["column", "category", *extra_keys]
        grouped = (
            df.withColumn("__pair", pairs).select("*", "__pair.column", "__pair.category")
            .filter("category IS NOT NULL").groupBy(*keys).agg(F.count("*").alias("__rows"), *[a.alias(n) for n, a in aggregates.items()])
        )
        names = list(aggregates)
        local = grouped.limit(max_local + 1).collect()
        if len(local) <= max_local:
            return CategoryTable._local(local, columns, names, list(extra_keys), codes)
        return CategoryTable._stored(grouped, columns, names, list(extra_keys), codes)

    @staticmethod
    def _local(rows, columns, names, extra_keys, codes) -> dict:
        state: dict = {"columns": {c: {"rows": []} for c in columns}, "names": list(names), "keys": extra_keys}
        rows.sort(key=lambda r: (r["category"],) + tuple(r[k] for k in extra_keys))
        for r in rows:
            held = state["columns"][r["column"]]["rows"]
            entry = [r["category"], *[r[k] for k in extra_keys], *[r[n] for n in names]]
            held.append(entry + [len(held)] if codes else entry)
        if codes:
            state["names"].append("code")
        return state

    @staticmethod
    def _stored(grouped, columns, names, extra_keys, codes) -> dict:
        spark = grouped.sparkSession
        path = scratch_path(spark, "categories")
        raw = f"{path}/grouped"
        grouped.write.partitionBy("column").parquet(raw)
        table = spark.read.parquet(raw)
        state: dict = {"columns": {}, "names": list(names), "keys": extra_keys}
        for c in columns:
            one = table.filter(F.col("column") == c).drop("column")
            heavy = one.groupBy("category").agg(F.sum("__rows").alias("n"), F.count("*").alias("entries"))
            total = heavy.agg(F.sum("n"), F.sum("entries")).first()  # an entry per category, or per category and extra key
            hot = heavy.filter(F.col("n") * HOT_SHARE > F.lit(total[0])).select("category").collect()
            where = raw
            if codes:
                where = f"{path}/codes/column={c}"
                number_values(one, "category", "code").write.parquet(where)
            state["columns"][c] = {
                "path": where, "coded": codes, "count": total[1] or 0, "hot": [r[0] for r in hot],
            }
        if codes:
            state["names"].append("code")
        return state

    @staticmethod
    def table(spark: SparkSession, state: dict, column: str, types: Mapping[str, str]) -> tuple[DataFrame, int, list]:
        """(category table, its size, hot categories) of one column."""
        held = state["columns"][column]
        wanted = ["category", *state["keys"], *state["names"]]
        if "rows" in held:
            kinds = {"category": "string", **types}
            columns = {n: pa.array([r[i] for r in held["rows"]], ARROW[kinds[n]]) for i, n in enumerate(wanted)}
            return spark.createDataFrame(pa.table(columns)), len(held["rows"]), []
        df = spark.read.parquet(held["path"])
        if not held["coded"]:
            df = df.filter(F.col("column") == column)
        return df.select(*wanted), held["count"], held["hot"]

    @staticmethod
    def join(
        df: DataFrame, state: dict, column: str, types: Mapping[str, str], to: Mapping[str, str],
        defaults: Mapping[str, object], rename_keys: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """Append ``to`` (statistic name -> new column) by looking the category up.

        A handful of categories become a CASE expression, so the step stays inside the projection.
        """
        held = state["columns"][column].get("rows")
        if held is not None and not state["keys"] and len(held) * len(to) <= MAX_BRANCHES:
            return CategoryTable._cases(df, state, column, types, to, defaults)
        table, rows, hot = CategoryTable.table(df.sparkSession, state, column, types)
        extra = [(rename_keys or {}).get(k, k) for k in state["keys"]]
        table = table.select(
            F.col("category").alias("__category"),
            *[F.col(k).alias(e) for k, e in zip(state["keys"], extra)],
            *[F.col(n).alias(t) for n, t in to.items()],
        )
        keyed = df.withColumn("__category", F.coalesce(quoted(column), F.lit(MISSING)))
        fill = {to[n]: v for n, v in defaults.items()}
        return lookup_join(keyed, table, ["__category", *extra], fill, rows=rows, hot=hot).drop("__category")

    @staticmethod
    def _cases(df, state, column, types, to, defaults) -> DataFrame:
        category = F.coalesce(quoted(column), F.lit(MISSING))
        out = [quoted(c) for c in df.columns]
        for name, target in to.items():
            at = 1 + state["names"].index(name)
            found = None
            for entry in state["columns"][column]["rows"]:
                hit, held = category == F.lit(entry[0]), F.lit(entry[at]).cast(types[name])
                found = F.when(hit, held) if found is None else found.when(hit, held)
            found = F.lit(None).cast(types[name]) if found is None else found
            if name in defaults:
                found = F.coalesce(found, F.lit(defaults[name]).cast(types[name]))
            out.append(found.alias(target))
        return df.select(*out)

    @staticmethod
    def categories(state: dict, column: str) -> list[str]:
        """Sorted categories of a column that is small enough to be held by the model."""
        held = state["columns"][column]
        if "rows" not in held:
            raise ValueError(f"{column!r} has {held['count']} categories, too many for one column each")
        return sorted({r[0] for r in held["rows"]})

"""Cross-products of columns, block by block: means, variances, correlations and normal equations from one pass.

The plan does not grow with the number of columns: rows go through Arrow batches as matrices, tasks add up the products
of each pair of column blocks, and the pair of blocks is the key of the aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.stats import quoted
from tabloom.operators.tasks import in_tasks

BLOCK = 256
#: Bytes of sums a task holds before it hands them on.
HELD = 128 << 20
#: What is added up over the rows in which both columns have a value.
SUMS = ("n", "x", "y", "xx", "yy", "xy")


def _blocks(count: int, block: int) -> list[range]:
    return [range(at, min(at + block, count)) for at in range(0, count, block)]


def block_products(df: DataFrame, left: Sequence[str], right: Sequence[str], fold: str | None = None, block: int = BLOCK, shifts: Mapping[str, float] | None = None) -> DataFrame:
    """(fold, i, j, sums): for each pair of column blocks the six sums, over rows complete for a pair.

    Values are shifted by ``shifts``, so that large means do not swallow small variances. NaN is missing.
    """
    names = list(dict.fromkeys([*left, *right]))
    place = {c: k for k, c in enumerate(names)}
    shift = np.array([(shifts or {}).get(c, 0.0) for c in names])
    rows = df.select(*[quoted(c).cast("double") for c in names], (quoted(fold).cast("int") if fold else F.lit(0)).alias("__fold"))
    lefts, rights = [[place[left[k]] for k in b] for b in _blocks(len(left), block)], [[place[right[k]] for k in b] for b in _blocks(len(right), block)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, int], np.ndarray] = {}

        def out() -> pa.RecordBatch:
            keys = list(zip(*held)) if held else ((), (), ())
            columns = [*[pa.array(k, pa.int32()) for k in keys], pa.array([v.tobytes() for v in held.values()], pa.binary())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, ["fold", "i", "j", "sums"])

        for batch in batches:
            data = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:-1]]).astype(np.float64) - shift
            folds = batch.column(len(names)).fill_null(-1).to_numpy()
            for k in np.unique(folds):
                own = data[folds == k]
                known = ~np.isnan(own)
                filled = np.where(known, own, 0.0)
                for i, a in enumerate(lefts):
                    for j, b in enumerate(rights):
                        x, y, mx, my = filled[:, a], filled[:, b], known[:, a].astype(float), known[:, b].astype(float)
                        if mx.all() and my.all():
                            ones = np.ones((len(a), len(b)))
                            sums = [ones * len(x), ones * x.sum(0)[:, None], ones * y.sum(0), ones * (x * x).sum(0)[:, None], ones * (y * y).sum(0), x.T @ y]
                        else:
                            sums = [mx.T @ my, x.T @ my, mx.T @ y, (x * x).T @ my, mx.T @ (y * y), x.T @ y]
                        key = int(k), i, j
                        made = np.stack(sums)
                        held[key] = held[key] + made if key in held else made
                        if sum(v.nbytes for v in held.values()) > HELD:
                            yield out()
        yield out()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            for *key, raw in zip(*[c.to_pylist() for c in batch.columns]):
                one = np.frombuffer(raw)
                key = tuple(key)
                held[key] = held[key] + one if key in held else one
        for (k, i, j), v in held.items():
            columns = [pa.array([k], pa.int32()), pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([v.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["fold", "i", "j", "sums"])

    schema = "fold int, i int, j int, sums binary"
    parts = in_tasks(rows, run, schema)
    pairs = len(lefts) * len(rights)
    parts = parts.repartition(min(pairs, 200), "fold", "i", "j") if pairs > 1 else parts.coalesce(1) if rows.rdd.getNumPartitions() <= 64 else parts.repartition(1)
    return in_tasks(parts, add, schema)


def one_row(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """The values of some row, 0 where it has none: good enough to shift by."""
    row = df.select(*[quoted(c).cast("double") for c in columns]).head(1)
    return {c: float(v) if v is not None and np.isfinite(v) else 0.0 for c, v in zip(columns, row[0])} if row else {}


def pair_sums(
    df: DataFrame, left: Sequence[str], right: Sequence[str], fold: str | None = None, block: int = BLOCK, shifts: Mapping[str, float] | None = None,
) -> dict[int, dict[str, np.ndarray]]:
    """The six sums as (left, right) matrices for each fold, on the driver: for results that are small by their columns."""
    lefts, rights = _blocks(len(left), block), _blocks(len(right), block)
    out: dict[int, dict[str, np.ndarray]] = {}
    for r in block_products(df, left, right, fold, block, shifts).toLocalIterator():
        a, b = lefts[r["i"]], rights[r["j"]]
        own = out.setdefault(r["fold"], {s: np.zeros((len(left), len(right))) for s in SUMS})
        for s, m in zip(SUMS, np.frombuffer(r["sums"]).reshape(6, len(a), len(b))):
            own[s][a.start:a.stop, b.start:b.stop] = m
    return out


def moments(s: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Population covariance, both variances and correlation of each pair; NaN without rows, correlation also if constant."""
    with np.errstate(invalid="ignore", divide="ignore"):
        n = np.where(s["n"] > 0, s["n"], np.nan)
        cov = s["xy"] / n - s["x"] / n * (s["y"] / n)
        vx, vy = (np.maximum(s[q + q] / n - (s[q] / n) ** 2, 0.0) for q in "xy")
        # what is left of a constant column is rounding of its squares
        vx, vy = (np.where(v <= 1e-15 * s[q + q] / n, 0.0, v) for v, q in ((vx, "x"), (vy, "y")))
        return {"n": s["n"], "cov": cov, "vx": vx, "vy": vy, "corr": np.where(vx * vy > 0, cov / np.sqrt(vx * vy), np.nan)}


def correlations_with(df: DataFrame, columns: Sequence[str], label: str) -> dict[str, float]:
    """Pearson correlation of each column with the label over complete pairs; NaN for a constant."""
    found = pair_sums(df, columns, [label], shifts=one_row(df, [*columns, label]))
    whole = {s: sum(f[s] for f in found.values()) for s in SUMS} if found else None
    return dict(zip(columns, moments(whole)["corr"][:, 0].tolist())) if whole else dict.fromkeys(columns, float("nan"))


def sample_variances(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Sample variance of each column; NaN below two values."""
    out: dict[str, float] = {}
    for b in _blocks(len(columns), 64):  # only the diagonal is needed: narrow blocks against themselves
        own = [columns[k] for k in b]
        found = pair_sums(df, own, own, shifts=one_row(df, own))
        s = {q: sum(f[q] for f in found.values()) for q in SUMS} if found else {q: np.zeros((len(own), len(own))) for q in SUMS}
        m, n = moments(s), s["n"].diagonal()
        out.update(zip(own, np.where(n > 1, m["vx"].diagonal() * n / np.where(n > 1, n - 1, 1), np.nan).tolist()))
    return out


def correlation_table(df: DataFrame, columns: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(a, b, corr) of every pair of columns, as a table: correlations of thousands of columns never pass the driver."""
    spans = _blocks(len(columns), block)
    names = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw in zip(*[batch.column(c).to_pylist() for c in ("i", "j", "sums")]):
                a, b = spans[i], spans[j]
                corr = moments(dict(zip(SUMS, np.frombuffer(raw).reshape(6, len(a), len(b)))))["corr"].ravel()
                columns_ = [np.repeat([names[k] for k in a], len(b)), np.tile([names[k] for k in b], len(a))]
                yield pa.RecordBatch.from_arrays([*[pa.array(c.tolist(), pa.string()) for c in columns_], pa.array(corr, mask=np.isnan(corr))], ["a", "b", "corr"])

    return in_tasks(block_products(df, columns, columns, block=block, shifts=one_row(df, columns)), run, "a string, b string, corr double")

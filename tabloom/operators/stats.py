"""Column classification, wide one-row aggregates, exact quantiles and hot keys."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.columns import nan_to_null


def numeric_columns(df: DataFrame, exclude: Iterable[str | None] = ()) -> list[str]:
    """Integers, floats and decimals in schema order; booleans are not numeric."""
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str | None] = ()) -> list[str]:
    skip = set(exclude)
    kinds = (T.StringType, T.VarcharType, T.CharType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds) and f.name not in skip]


def datetime_columns(df: DataFrame, exclude: Iterable[str | None] = ()) -> list[str]:
    skip = set(exclude)
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds) and f.name not in skip]


def value(df: DataFrame, name: str) -> Column:
    """A column with NaN already turned into NULL."""
    return nan_to_null(quoted(name), df.schema[name].dataType.simpleString())


def quoted(name: str) -> Column:
    """A column reference that is safe for names with dots or spaces."""
    return F.col(f"`{name}`")


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs; NULL for a constant column (``corr`` would fail in ANSI mode)."""
    x, y = F.when(y.isNotNull(), x.cast("double")), F.when(x.isNotNull(), y.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def summarize(df: DataFrame, wanted: Mapping[str, Mapping[str, Callable]]) -> tuple[int, dict[str, dict]]:
    """(rows, ``{column: {name: value}}``): all aggregates of all columns in one job."""
    places = [(c, name) for c, aggregates in wanted.items() for name in aggregates]
    rows, *values = df.agg(F.count(F.lit(1)), *[wanted[c][name](value(df, c)) for c, name in places]).first()
    found: dict[str, dict] = {c: {} for c in wanted}
    for (c, name), v in zip(places, values):
        found[c][name] = v
    return rows, found


def aggregate_columns(df: DataFrame, columns: Sequence[str], **aggregates: Callable) -> dict[str, dict]:
    """The same aggregates over several columns in one job: ``{column: {name: value}}``."""
    return summarize(df, dict.fromkeys(columns, aggregates))[1] if columns else {}


MIN_SORTED = 1_000


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    max_values: int = 500_000,
    sample: int = 1_000_000,
    accuracy: int = 10_000,
) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation, all columns together.

    ``percentile`` keeps every distinct value of a column in one task. Here each wanted order
    statistic is enclosed in a bracket instead: a sample of the bracket proposes two values around
    it, a counting pass over all rows proves on which side of them the statistic lies, and that
    repeats until a bracket holds few enough values to be sorted as they are. A round shrinks a
    bracket some hundredfold, so 10^12 rows need about three rounds. No pass shuffles rows, and
    ties - however heavy - end a search early because a proposed value is itself an answer.
    """
    if not columns:
        return {}
    narrow = df.select(*[value(df, c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)]).persist()
    try:
        counts, wanted = _order_statistics(narrow, columns, probabilities, max_values, sample, accuracy)
    finally:
        narrow.unpersist()

    result = {}
    for i, (c, n) in enumerate(zip(columns, counts)):
        result[c] = []
        for p in probabilities:
            if not n:
                result[c].append(None)
                continue
            position = p * (n - 1)
            low, high = wanted[i, math.floor(position)], wanted[i, math.ceil(position)]
            result[c].append(low + (high - low) * (position - math.floor(position)))
    return result


def _order_statistics(data, columns, probabilities, max_values, sample, accuracy) -> tuple[list[int], dict]:
    """(values per column, (column, rank) -> value): the passes read the narrow columns, which are kept between them."""
    counts = data.agg(*[F.count(f"v{i}") for i in range(len(columns))]).first()

    wanted: dict[tuple[int, int], float | None] = {}
    for i, n in enumerate(counts):
        for p in probabilities if n else ():
            position = p * (n - 1)
            wanted[i, math.floor(position)] = None
            wanted[i, math.ceil(position)] = None

    # Open search: (column, rank) -> values strictly inside (low, high), with `below` rows before it.
    search = {t: (-math.inf, math.inf, 0, counts[t[0]]) for t in wanted}
    while search:
        brackets = {(t[0],) + b for t, b in search.items()}
        limit = max(MIN_SORTED, max_values // len(brackets))
        wide = {t: b for t, b in search.items() if b[3] > limit}
        if not wide:
            break
        _narrow(data, wide, search, wanted, sample, accuracy)

    if search:
        _select(data, search, wanted)
    return counts, wanted


def _inside(i: int, low: float, high: float) -> Column:
    v = F.col(f"v{i}")
    keep = v.isNotNull()
    if low != -math.inf:
        keep = keep & (v > F.lit(low))
    if high != math.inf:
        keep = keep & (v < F.lit(high))
    return keep


def _narrow(data, wide, search, wanted, sample, accuracy) -> None:
    targets = list(wide)
    sketches = []
    for i, rank in targets:
        low, high, below, inside = wide[i, rank]
        share = min(1.0, sample / inside)
        at = (rank - below) / max(1, inside - 1)
        spread = 4 * math.sqrt(at * (1 - at) / (share * inside)) if share < 1 else 0.0
        around = [max(0.0, at - spread - 2 / accuracy), min(1.0, at + spread + 2 / accuracy)]
        drawn = _inside(i, low, high) & (F.col("__draw") < F.lit(share))
        sketches.append(F.percentile_approx(F.when(drawn, F.col(f"v{i}")), around, accuracy))
    proposals = data.withColumn("__draw", F.rand(17)).agg(*sketches).first()
    # an empty sample proposes nothing: the whole bracket is sketched next time
    empty = [t for t, p in zip(targets, proposals) if p is None]
    if empty:
        again = {t: wide[t] for t in empty}
        _narrow(data, again, search, wanted, max(wide[t][3] for t in empty), accuracy)
        kept = [(t, p) for t, p in zip(targets, proposals) if p is not None]
        targets, proposals = [t for t, _ in kept], [p for _, p in kept]
        if not targets:
            return

    counts = []
    for (i, rank), (a, b) in zip(targets, proposals):
        inside, v = _inside(i, *wide[i, rank][:2]), F.col(f"v{i}")
        counts += [
            F.count_if(inside & (v < F.lit(a))),
            F.count_if(inside & (v == F.lit(a))),
            F.count_if(inside & (v > F.lit(a)) & (v < F.lit(b))),
            F.count_if(inside & (v == F.lit(b))) if b > a else F.sum(F.lit(0)),
        ]
    counted = data.agg(*counts).first()

    for t, target in enumerate(targets):
        (a, b), (less, at_a, between, at_b) = proposals[t], counted[4 * t:4 * t + 4]
        low, high, below, inside = search.pop(target)
        offset = target[1] - below
        if offset < less:
            search[target] = (low, a, below, less)
        elif offset < less + at_a:
            wanted[target] = a
        elif offset < less + at_a + between:
            search[target] = (a, b, below + less + at_a, between)
        elif offset < less + at_a + between + at_b:
            wanted[target] = b
        else:
            done = less + at_a + between + at_b
            search[target] = (b, high, below + done, inside - done)


def _select(data, search, wanted) -> None:
    targets = list(search)
    exprs = []
    for i, rank in targets:
        low, high, below, _ = search[i, rank]
        ordered = F.sort_array(F.collect_list(F.when(_inside(i, low, high), F.col(f"v{i}"))))
        exprs.append(F.element_at(ordered, rank - below + 1))
    for target, found in zip(targets, data.agg(*exprs).first()):
        wanted[target] = found


RANGE_ROWS = 500_000
MAX_RANGES = 10_000


def cut_points(df: DataFrame, c: Column, range_rows: int = RANGE_ROWS) -> tuple[list[float], list[float]]:
    """(ascending cut points, hot values) of a numeric expression, from a bounded sample.

    There is one cut per ``range_rows`` rows, at most ``MAX_RANGES``. A value that fills two
    neighbouring cuts holds several ranges' worth of rows: it is reported as hot. The cut points
    only steer parallelism; results built on them are exact wherever they fall.
    """
    values = df.select(c.cast("double").alias("v")).dropna()
    rows = values.count()
    parts = min(MAX_RANGES, rows // range_rows + 1)
    if parts == 1:
        return [], []
    share = 200 * max(parts, 1_000) / rows
    drawn = values.sample(share, 17) if share < 0.5 else values
    steps = [k / parts for k in range(1, parts)]
    cuts = drawn.agg(F.percentile_approx("v", steps, 10 * max(parts, 1_000))).first()[0] or []
    hot = sorted({a for a, b in zip(cuts, cuts[1:]) if a == b})
    return sorted(set(cuts)), hot


HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, key: str, min_rows: int | None = None) -> list:
    """Keys with more than ``min_rows`` rows, NULL included; at most rows/min_rows of them.

    The limit is a number of rows that one task may hold, whatever the size of the table.
    """
    counted = df.groupBy(quoted(key).alias("k")).count()
    return [r["k"] for r in counted.filter(F.col("count") > (HOT_ROWS if min_rows is None else min_rows)).select("k").collect()]


def one_of(column: str, values: Sequence) -> Column:
    """Whether a column holds one of some values; NULL can be among them."""
    known = quoted(column).isin([v for v in values if v is not None])
    missing = quoted(column).isNull() if None in values else F.lit(False)
    return F.coalesce(known, F.lit(False)) | missing

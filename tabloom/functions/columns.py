"""Scalar column expressions. All of them stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# Order of the condition grades.
CONDITION_RANKS = {"POOR": 1, "FAIR": 2, "GOOD": 3, "EXCELLENT": 4}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str, dtype: str = "double") -> Column:
    """Missing is NULL everywhere in this package; NaN only exists in floating columns."""
    c = _col(c)
    return F.when(~F.isnan(c), c) if dtype in ("double", "float") else c


def clean_numeric(c: Column | str, low: float = 0, high: float | None = None) -> Column:
    """Keep ``x > low``; with ``high`` given keep ``low <= x <= high``. Anything else is NULL."""
    c = _col(c)
    keep = c > F.lit(low) if high is None else c.between(F.lit(low), F.lit(high))
    return F.when(keep, c)


def clean_string(c: Column | str) -> Column:
    """Strip white space (Unicode) at both ends and upper-case."""
    return F.upper(F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", ""))


def ordinal(c: Column | str, ranks: Mapping[str, int] = CONDITION_RANKS) -> Column:
    """Rank of a grade after :func:`clean_string`; unknown grades are NULL."""
    cleaned = clean_string(c)
    out = None
    for grade, rank in ranks.items():
        hit = cleaned == F.lit(grade)
        out = F.when(hit, F.lit(rank)) if out is None else out.when(hit, F.lit(rank))
    return out


def clip(c: Column | str, low: float | None, high: float | None) -> Column:
    """Clip that keeps NULL (``greatest``/``least`` would skip it). A missing bound is open."""
    c = _col(c)
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return out if out is c else F.when(c.isNotNull(), out)


def safe_log(c: Column | str) -> Column:
    """``log1p`` with missing and negative input taken as 0, so never NaN or infinite."""
    return F.log1p(F.greatest(F.coalesce(_col(c), F.lit(0.0)), F.lit(0.0)))


def safe_sqrt(c: Column | str) -> Column:
    return F.sqrt(F.greatest(F.coalesce(_col(c), F.lit(0.0)), F.lit(0.0)))


def safe_divide(a: Column | str, b: Column | str) -> Column:
    """a / b; 0 where b is 0; NULL where an operand is NULL."""
    a, b = _col(a).cast("double"), _col(b).cast("double")
    return F.when(b == 0, F.when(a.isNotNull(), F.lit(0.0))).otherwise(a / b)


def epoch_micros(c: Column | str) -> Column:
    """Microseconds since 1970 on the column's own clock (no session time zone involved)."""
    return F.timestamp_diff(
        "MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _col(c).cast("timestamp_ntz")
    )


def format_score(c: Column | str, precision: int = 4) -> Column:
    """Fixed number of decimals as text."""
    return F.format_string(f"%.{precision}f", _col(c).cast("double"))


def run_name(prefix: Column | str, ts: Column | str, suffix: str = "") -> Column:
    """``<prefix>_<yyyyMMdd_HHmmss><suffix>``, the name a timestamped result gets."""
    stamp = F.date_format(_col(ts), "yyyyMMdd_HHmmss")
    return F.concat(_col(prefix), F.lit("_"), stamp, F.lit(suffix))


def positive_probability(probability: Column | str) -> Column:
    """Element 1 of a probability vector."""
    return vector_to_array(_col(probability))[1]

"""Column expressions: cleaning, clipping, hashing, formatting."""

from tabloom.functions.columns import (
    CONDITION_RANKS,
    clean_numeric,
    clean_string,
    clip,
    epoch_micros,
    format_score,
    nan_to_null,
    ordinal,
    positive_probability,
    run_name,
    safe_divide,
    safe_log,
    safe_sqrt,
)
from tabloom.functions.hashing import hash28, uniform

__all__ = [
    "CONDITION_RANKS", "clean_numeric", "clean_string", "clip", "epoch_micros", "format_score",
    "hash28", "nan_to_null", "ordinal", "positive_probability", "run_name", "safe_divide",
    "safe_log", "safe_sqrt", "uniform",
]

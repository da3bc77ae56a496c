from tabprep.functions.scalar import (
    class_weight,
    date_stamps,
    decode,
    indicator,
    is_missing,
    nan_to_null,
    numeric_columns,
    relu,
    round_half_even,
    sigmoid,
    threshold,
)

__all__ = [
    "class_weight",
    "date_stamps",
    "decode",
    "indicator",
    "is_missing",
    "nan_to_null",
    "numeric_columns",
    "relu",
    "round_half_even",
    "sigmoid",
    "threshold",
]

from .scalar import (
    abs_error,
    f1_expr,
    int_bucket,
    iso_seconds_text,
    label_above,
    label_outside,
    parse_seconds,
    precision_expr,
    recall_expr,
    round_to,
    signed_axis,
    time_bucket,
    to_decimal,
    vector_element,
    zscore,
)

__all__ = [
    "abs_error",
    "f1_expr",
    "int_bucket",
    "iso_seconds_text",
    "label_above",
    "label_outside",
    "parse_seconds",
    "precision_expr",
    "recall_expr",
    "round_to",
    "signed_axis",
    "time_bucket",
    "to_decimal",
    "vector_element",
    "zscore",
]

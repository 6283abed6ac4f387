from .labels import canonical_labels, labels_map
from .scalar import (
    double_text,
    epoch_ms,
    epoch_us,
    is_non_finite,
    md5_int,
    nan_to_null,
    ntz_lit,
    qualified_name,
    quote_ident,
    size_pretty,
    sql_quote,
)
from .time import ceil_bucket, floor_bucket, newer_than_pred, older_than_pred, time_range

__all__ = [
    "canonical_labels",
    "labels_map",
    "double_text",
    "epoch_ms",
    "epoch_us",
    "is_non_finite",
    "md5_int",
    "nan_to_null",
    "ntz_lit",
    "qualified_name",
    "quote_ident",
    "size_pretty",
    "sql_quote",
    "ceil_bucket",
    "floor_bucket",
    "newer_than_pred",
    "older_than_pred",
    "time_range",
]

"""Label-set text (J3): the same label set always gives the same key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import ColumnOrName, _c

LABELS_TYPE = "map<string,string>"


def labels_map(labels: ColumnOrName) -> Column:
    return F.from_json(_c(labels), LABELS_TYPE)


def valid_labels(labels: ColumnOrName) -> Column:
    """Whether the text is a JSON object of labels."""
    return F.coalesce(labels_map(labels).isNotNull() & _c(labels).rlike(r"^\s*\{"), F.lit(False))


def canonical_labels(labels: ColumnOrName) -> Column:
    """JSON object text with keys sorted; key order of the input does not matter. Label
    values are text, so ``{"a":1}`` and ``{"a":"1"}`` are one set. Null for invalid text
    (see :func:`valid_labels`)."""
    entries = F.array_sort(F.map_entries(labels_map(labels)))
    return F.to_json(F.map_from_entries(entries))

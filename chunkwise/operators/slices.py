"""Range slices of an order, decided by a row's own content.

The bounds are an equi-depth sample of the order columns. A row's slice is the number
of bounds that are not above it, found by binary search in a column expression, so it
doesn't depend on which task reads the row or on how a shuffle was partitioned: two
jobs over the same rows, or a task that runs again, give the same slices.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_SLICE = 1_000_000
MAX_SLICES = 1 << 15  # more rows than MAX_SLICES * ROWS_PER_SLICE make larger slices, sorted with spill
_SAMPLED_PER_SLICE = 8


def _ordered(df: DataFrame, columns: Sequence[str]) -> Column:
    """The columns as one comparable struct; nulls come before values, as in ORDER BY."""
    return F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)])


def slice_bounds(
    df: DataFrame, columns: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE, prepare: Callable[[DataFrame], DataFrame] | None = None
) -> str | None:
    """Bounds as JSON text, at most ``MAX_SLICES`` of them; None if one slice holds all rows.

    Rows are counted, then a sample of about eight a slice is sorted and every eighth is a
    bound. Bounds steer only how evenly rows are spread; any would give right results. With
    ``prepare``, the columns are those of ``prepare(df)``, which turns each row into one or
    none: the rows are counted as they are and only sampled ones are prepared.
    """
    if rows_per_slice < 1:
        raise ValueError("rows_per_slice must be >= 1")
    n_rows = df.count()
    n_slices = min(MAX_SLICES, -(-n_rows // rows_per_slice))
    if n_slices <= 1:
        return None
    fraction = min(1.0, n_slices * _SAMPLED_PER_SLICE / n_rows)
    sample = df.sample(False, fraction, seed=7)
    sample = sample if prepare is None else prepare(sample)
    sample = sample.select(_ordered(sample, columns).alias("_r"))
    ranked = F.sort_array(F.collect_list("_r"))
    step = max(1, round(n_rows * fraction / n_slices))
    keep = F.filter(ranked, lambda r, i: i % step == step - 1)
    return sample.agg(F.to_json(keep, {"ignoreNullFields": "false"}).alias("b")).first()["b"]


def slice_number(df: DataFrame, columns: Sequence[str], bounds: str | None) -> Column:
    """The slice (from 0) of a row of ``df``; slices follow the order of ``columns``."""
    if bounds is None:
        return F.lit(0)
    fields = [T.StructField(f"_{i}", df.schema[c].dataType) for i, c in enumerate(columns)]
    # parsed and sorted once, as a constant; texts that round a value stay valid bounds
    known = F.sort_array(F.from_json(F.lit(bounds), T.ArrayType(T.StructType(fields))))
    steps = [1 << k for k in reversed(range(len(json.loads(bounds)).bit_length()))]

    def slice_of(row: Column) -> Column:
        def further(low: Column, step: Column) -> Column:
            # beyond the last bound get() is null, which is no step forward
            return F.when(F.get(known, low + step - 1) <= row, low + step).otherwise(low)

        return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), further)

    # bound to a variable: written into the search, the columns' expressions would be
    # computed anew for each of its steps
    return F.get(F.transform(F.array(_ordered(df, columns)), slice_of), F.lit(0))

"""Chunk-bucket arithmetic and the raw-time predicate used for chunk exclusion.

Chunks are epoch-aligned buckets of a fixed interval. A predicate on a derived
bucket bound (``bucket_end <= cutoff``) cannot reach the Parquet scan, so the
helpers translate it into the equivalent predicate on the raw ``ts`` column.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import parse_interval
from .scalar import ntz_lit

_EPOCH = dt.datetime(1970, 1, 1)


def floor_bucket(t: dt.datetime, every: str) -> dt.datetime:
    width = parse_interval(every)
    n = (t - _EPOCH) // width
    return _EPOCH + n * width


def ceil_bucket(t: dt.datetime, every: str) -> dt.datetime:
    f = floor_bucket(t, every)
    return f if f == t else f + parse_interval(every)


def older_than_pred(ts: str, cutoff: dt.datetime, every: str) -> Column:
    """Rows of chunks whose whole range ends at or before ``cutoff``."""
    return F.col(ts) < ntz_lit(floor_bucket(cutoff, every))


def newer_than_pred(ts: str, cutoff: dt.datetime, every: str) -> Column:
    """Rows of chunks whose whole range starts at or after ``cutoff``."""
    return F.col(ts) >= ntz_lit(ceil_bucket(cutoff, every))


def time_range(df: DataFrame, lo: dt.datetime | None = None, hi: dt.datetime | None = None, ts: str = "ts") -> DataFrame:
    """Keep ``lo <= ts < hi``; a plain column predicate, so it is pushed to the scan."""
    if lo is not None:
        df = df.filter(F.col(ts) >= ntz_lit(lo))
    if hi is not None:
        df = df.filter(F.col(ts) < ntz_lit(hi))
    return df

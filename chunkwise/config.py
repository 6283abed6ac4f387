"""Run parameters and the shared work folder.

Every time-dependent operation takes an explicit ``as_of`` instead of
``now()`` so results are reproducible.
"""

from __future__ import annotations

import datetime as dt
import re
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# Fixed values that must equal the database the tools talk to:
# default schema of the sample tables and schema of the chunk tables.
DEFAULT_SCHEMA = "prom_data"
CHUNK_SCHEMA = "_timescaledb_internal"

_UNIT_SECONDS = {
    "microsecond": 1e-6,
    "millisecond": 1e-3,
    "second": 1,
    "minute": 60,
    "hour": 3600,
    "day": 86400,
    "week": 7 * 86400,
}


def parse_interval(text: str) -> dt.timedelta:
    """'10 days' / '1 day' / '6 hours' -> timedelta (fixed-length units only)."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+?)s?\s*", text)
    if not m or m.group(2).lower() not in _UNIT_SECONDS:
        raise ValueError(f"unsupported interval {text!r}")
    return dt.timedelta(seconds=int(m.group(1)) * _UNIT_SECONDS[m.group(2).lower()])


@dataclass(frozen=True)
class Params:
    schema: str = DEFAULT_SCHEMA
    chunk_schema: str = CHUNK_SCHEMA
    every: str = "1 day"  # chunk interval
    as_of: dt.datetime = dt.datetime(2024, 1, 31)
    age: str = "10 days"  # older_than / newer_than argument
    batch_size: int = 5
    tier: str = "cold_space"
    index_tier: str = "cold_space"
    extra: dict = field(default_factory=dict)

    @property
    def cutoff(self) -> dt.datetime:
        return self.as_of - parse_interval(self.age)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder (``spark.checkpoint.dir``).

    A local session without one gets a private folder; a cluster session
    without one is an error, because executors would each write to their own disk.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="chunkwise-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def materialize(df, name: str = "table"):
    """Cut the lineage of a small, reused intermediate (a dictionary or id
    table): written once as Parquet under the shared checkpoint folder and read
    back by every branch that uses it; survives executor loss.

    A written table rather than ``checkpoint()``: an eager RDD checkpoint
    computes its input twice (count, then the checkpoint write), and the
    Parquet read gives adaptive execution real sizes for its join choices.
    """
    spark = df.sparkSession
    path = work_dir(spark, "materialized", name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The folder comes from ``spark.checkpoint.dir``; see ``ensure_checkpoint_dir``.
    """
    base = ensure_checkpoint_dir(spark)
    return "/".join([base.rstrip("/"), "chunkwise", uuid.uuid4().hex, *parts])

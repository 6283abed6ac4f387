"""Entry point "chunk mover": for a list of tables, pick each table's largest
chunk older than the age limit, check it may go to the cold tier, and rewrite
it there sorted by the table's index. Plan and rewrite are separate steps so
the plan can be reviewed; the hot copy is never removed here."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..config import Params, materialize
from ..operators import chunks as C
from ..operators import tiering as T


@dataclass
class MoveRun:
    plan: DataFrame
    status: DataFrame | None


def plan_moves(samples: DataFrame, tables: Iterable[str], attachments: DataFrame, indexes: DataFrame,
               params: Params = Params()) -> DataFrame:
    """C1 (with the age cutoff pushed to the scan) -> C9 -> T1 -> index -> plan rows."""
    old = C.chunk_inventory(samples, every=params.every, schema=params.schema, chunk_schema=params.chunk_schema,
                            older_than=params.cutoff)
    old = materialize(old, "old_chunks")  # listing and catalog come from one pass over the samples
    # only tables with an old chunk can get a plan row: their catalog comes from the same listing
    catalog = C.hypertable_catalog(old)
    return T.move_plan(old, catalog, indexes, attachments, tables, params.schema, params.tier, params.index_tier)


def run_chunk_mover(spark: SparkSession, hot_path: str, cold_path: str, tables: Iterable[str],
                    attachments: DataFrame, indexes: DataFrame, params: Params = Params(),
                    execute: bool = True) -> MoveRun:
    """Plan over the stored hot tier and (optionally) move; returns the plan and
    the per-chunk row check (``ok`` must hold for every chunk before the caller
    drops the hot copies)."""
    samples = spark.read.parquet(hot_path)
    # the reviewed plan is written once; moving, checking and reading use that table
    plan = materialize(plan_moves(samples, tables, attachments, indexes, params), "move_plan")
    status = T.move_chunks(spark, hot_path, cold_path, plan) if execute else None
    return MoveRun(plan, status)

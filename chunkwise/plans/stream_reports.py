"""Registered streaming query: the incremental chunk inventory equals C1."""

from __future__ import annotations

from ..config import work_dir
from ..streaming.inventory import read_inventory, run_incremental_inventory, stream_events_as_samples
from . import sql_common as S
from .registry import register


@register("streaming_chunk_inventory", S.BASE + "SELECT * FROM chunks")
def q_streaming_chunk_inventory(spark, sf_dir):
    table, checkpoint = work_dir(spark, "inventory"), work_dir(spark, "inventory_checkpoint")
    run_incremental_inventory(stream_events_as_samples(spark, sf_dir, "events.parquet"), table, checkpoint)
    return read_inventory(spark, table)

"""Incremental chunk inventory (the periodic rule, run as Structured Streaming).

New sample files are picked up by a file stream; the chunk partial sums
(row count, payload bytes) live in the streaming state store keyed by chunk.
Each micro-batch writes the chunks it changed under ``batch_id=<n>`` (rewritten
as a whole on retry, so the sink is exactly-once); readers take the newest row
per chunk. No watermark by default: late rows still update their chunk
instead of being dropped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CHUNK_SCHEMA, DEFAULT_SCHEMA
from ..operators.chunks import CHUNK_COLUMNS, chunk_groups, chunks_from_groups

CHUNK_KEY = ["hypertable_schema", "hypertable_name", "node_name", "range_start"]


def chunk_partials(samples: DataFrame, every: str = "1 day", watermark: str | None = None) -> DataFrame:
    """Streaming C1 aggregate: (metric, node, bucket) -> n_rows, toast_bytes."""
    if watermark is not None:
        samples = samples.withWatermark("ts", watermark)
    return chunk_groups(samples, every)


def run_incremental_inventory(
    samples_stream: DataFrame,
    table_path: str,
    checkpoint_path: str,
    every: str = "1 day",
    schema: str = DEFAULT_SCHEMA,
    chunk_schema: str = CHUNK_SCHEMA,
    watermark: str | None = None,
) -> None:
    """Process every sample file available now, update the chunk table, stop.

    Run it again (e.g. from a scheduler) to fold in files that arrived since;
    the checkpoint remembers processed files and the chunk sums.
    """
    partials = chunk_partials(samples_stream, every, watermark)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        chunks = chunks_from_groups(batch, every, schema, chunk_schema).withColumn("batch_id", F.lit(batch_id).cast("long"))
        (
            chunks.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(table_path)
        )

    query = (
        partials.writeStream.outputMode("update")
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_inventory(spark: SparkSession, table_path: str) -> DataFrame:
    """The current chunk inventory: newest row per chunk over all batches.

    ``max_by`` over the batch id is an algebraic aggregate (partial + final), so
    a chunk touched by every batch is still reduced map-side.
    """
    log = spark.read.parquet(table_path)
    rest = [c for c in CHUNK_COLUMNS if c not in CHUNK_KEY]
    newest = log.groupBy(*CHUNK_KEY).agg(F.max_by(F.struct(*rest), "batch_id").alias("_v"))
    return newest.select(*CHUNK_KEY, *[F.col("_v." + c).alias(c) for c in rest]).select(*CHUNK_COLUMNS)


def compact_inventory(spark: SparkSession, table_path: str, out_path: str) -> DataFrame:
    """Write the current inventory (newest row per chunk) to ``out_path`` as one
    batch, so readers of a long-running log scan one row per chunk. The caller
    swaps the paths once the write succeeded; the log itself is left as it is."""
    current = read_inventory(spark, table_path)
    top = spark.read.parquet(table_path).agg(F.max("batch_id")).first()[0]
    current.withColumn("batch_id", F.lit(top).cast("long")).write.mode("overwrite").partitionBy("batch_id").parquet(out_path)
    return read_inventory(spark, out_path)


def stream_events_as_samples(spark: SparkSession, folder: str, glob: str = "events*.parquet", max_files: int | None = None) -> DataFrame:
    """File stream over the events files of a folder, as canonical samples."""
    from ..model import samples_from_events

    schema = spark.read.parquet(os.path.join(folder, glob)).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return samples_from_events(reader.parquet(folder))

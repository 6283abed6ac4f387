"""Chunk inventory and chunk listings (C1, C3-C9) and the hypertable catalog (S3).

C1 is the heavy, distributed step: sample rows are grouped into chunks
(metric x node x epoch-aligned time bucket) with a partial + final hash
aggregate, so even a hot chunk costs one row per map task in the shuffle.
Everything after C1 works on the chunk catalog, which is orders of magnitude
smaller than the samples.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CHUNK_SCHEMA, DEFAULT_SCHEMA, parse_interval
from ..functions.scalar import ntz_lit, qualified_name
from ..functions.time import newer_than_pred, older_than_pred

# Logical row and index widths of the chunk-size model (bytes per row).
TABLE_BYTES_PER_ROW = 24
INDEX_BYTES_PER_ROW = 16

CHUNK_COLUMNS = [
    "hypertable_schema",
    "hypertable_name",
    "chunk_schema",
    "chunk_name",
    "node_name",
    "range_start",
    "range_end",
    "n_rows",
    "table_bytes",
    "index_bytes",
    "toast_bytes",
    "total_bytes",
]


def _name_format(every: str) -> str:
    return "yyyyMMdd" if parse_interval(every) % dt.timedelta(days=1) == dt.timedelta(0) else "yyyyMMddHHmmss"


def chunk_inventory(
    samples: DataFrame,
    every: str = "1 day",
    schema: str = DEFAULT_SCHEMA,
    chunk_schema: str = CHUNK_SCHEMA,
    older_than: dt.datetime | None = None,
    newer_than: dt.datetime | None = None,
) -> DataFrame:
    """Rows -> chunks with time range and logical table/index/toast/total bytes.

    ``older_than`` / ``newer_than`` (absolute cutoffs) keep only chunks lying
    wholly before / after the cutoff; the equivalent predicate on raw ``ts`` is
    applied before grouping so it reaches the Parquet scan (chunk exclusion).
    """
    rows = samples
    if older_than is not None:
        rows = rows.filter(older_than_pred("ts", older_than, every))
    if newer_than is not None:
        rows = rows.filter(newer_than_pred("ts", newer_than, every))
    chunks = chunks_from_groups(chunk_groups(rows, every), every, schema, chunk_schema)
    # exact bounds on the chunk ranges (the raw predicate above already implies them)
    if older_than is not None:
        chunks = chunks.filter(F.col("range_end") <= ntz_lit(older_than))
    if newer_than is not None:
        chunks = chunks.filter(F.col("range_start") >= ntz_lit(newer_than))
    return chunks


def chunk_groups(rows: DataFrame, every: str, *more: str) -> DataFrame:
    """(metric, node, bucket ``w``) -> n_rows, toast_bytes: the aggregate under C1
    (also used by the streaming inventory, where it is the stateful part); ``more`` keys
    split the groups further (by file, for the refreshed catalog)."""
    return rows.groupBy(*more, "metric", "node", F.window("ts", every).alias("w")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).cast("long").alias("toast_bytes"),
    )


def chunks_from_groups(grouped: DataFrame, every: str, schema: str, chunk_schema: str) -> DataFrame:
    """Chunk rows (names, range, logical sizes) from :func:`chunk_groups` output."""
    table_bytes = (F.col("n_rows") * TABLE_BYTES_PER_ROW).cast("long")
    index_bytes = (F.col("n_rows") * INDEX_BYTES_PER_ROW).cast("long")
    return grouped.select(
        F.lit(schema).alias("hypertable_schema"),
        F.col("metric").alias("hypertable_name"),
        F.lit(chunk_schema).alias("chunk_schema"),
        F.concat(
            F.lit("_hyper_"), F.col("metric"), F.lit("_"),
            F.date_format(F.col("w.start"), _name_format(every)), F.lit("_"),
            F.col("node"), F.lit("_chunk"),
        ).alias("chunk_name"),
        F.col("node").alias("node_name"),
        F.col("w.start").alias("range_start"),
        F.col("w.end").alias("range_end"),
        F.col("n_rows").cast("long").alias("n_rows"),
        table_bytes.alias("table_bytes"),
        index_bytes.alias("index_bytes"),
        F.col("toast_bytes"),
        (table_bytes + index_bytes + F.col("toast_bytes")).alias("total_bytes"),
    )


def save_catalog(chunks: DataFrame, path: str) -> None:
    """Store a chunk inventory (one folder per table, dynamic overwrite), so the
    reports run on the catalog instead of rescanning the samples."""
    (
        chunks.select(*CHUNK_COLUMNS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("hypertable_name")
        .parquet(path)
    )


def load_catalog(spark, path: str) -> DataFrame:
    """A stored chunk inventory (from :func:`save_catalog` or the streaming
    inventory's :func:`chunkwise.streaming.inventory.read_inventory`)."""
    return spark.read.parquet(path).select(*CHUNK_COLUMNS)


def hypertable_catalog(chunks: DataFrame) -> DataFrame:
    """S3: one row per hypertable with its sorted array of data nodes and chunk count."""
    return chunks.groupBy("hypertable_schema", "hypertable_name").agg(
        F.array_sort(F.collect_set("node_name")).alias("data_nodes"),
        F.count(F.lit(1)).alias("num_chunks"),
    )


def chunk_full_name(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("chunk_full_name", F.concat(F.col("chunk_schema"), F.lit("."), F.col("chunk_name")))


def chunks_of(chunks: DataFrame, schema: str, table: str, node: str | None = None, ordered: bool = True) -> DataFrame:
    """Detail of one table (optionally one node), largest first."""
    out = chunks.filter((F.col("hypertable_schema") == schema) & (F.col("hypertable_name") == table))
    if node is not None:
        out = out.filter(F.col("node_name") == node)
    return out.orderBy(F.col("total_bytes").desc_nulls_last(), "chunk_name") if ordered else out


def chunks_all(hypertables: DataFrame, chunks: DataFrame, schema: str) -> DataFrame:
    """C4: the lateral call per table, as an equi-join on (schema, name)."""
    ht = hypertables.filter(F.col("hypertable_schema") == schema).select("hypertable_schema", "hypertable_name")
    return ht.join(chunks, ["hypertable_schema", "hypertable_name"]).select(
        "hypertable_schema", "hypertable_name", "chunk_name", "total_bytes", "index_bytes", "toast_bytes", "table_bytes"
    )


def show_chunks(
    chunks: DataFrame,
    table: str | None = None,
    older_than: dt.datetime | None = None,
    newer_than: dt.datetime | None = None,
    schema: str | None = None,
) -> DataFrame:
    """Chunks by age (absolute cutoffs). Prefer passing the cutoffs to
    :func:`chunk_inventory` so the scan is pruned as well."""
    out = chunks
    if schema is not None:
        out = out.filter(F.col("hypertable_schema") == schema)
    if table is not None:
        out = out.filter(F.col("hypertable_name") == table)
    if older_than is not None:
        out = out.filter(F.col("range_end") <= ntz_lit(older_than))
    if newer_than is not None:
        out = out.filter(F.col("range_start") >= ntz_lit(newer_than))
    return chunk_full_name(out)


def show_chunks_all(hypertables: DataFrame, chunks: DataFrame, schema: str, **age) -> DataFrame:
    """C5 over every table of a schema (lateral join = equi-join)."""
    ht = hypertables.filter(F.col("hypertable_schema") == schema).select("hypertable_schema", "hypertable_name")
    listed = show_chunks(chunks, schema=schema, **age)
    return ht.join(listed, ["hypertable_schema", "hypertable_name"])


def old_chunks_with_size(listing: DataFrame, sizes: DataFrame) -> DataFrame:
    """Chunk listing joined to its sizes by full chunk name."""
    named = chunk_full_name(sizes).select("chunk_full_name", "total_bytes")
    return listing.select("hypertable_schema", "hypertable_name", "chunk_full_name").join(named, "chunk_full_name")


def largest_chunks(chunks: DataFrame) -> DataFrame:
    """Every chunk equal to the maximum size of its table (ties kept).

    The per-table maximum is a hash aggregate (partial + final, so a table owning
    most chunks is still spread over tasks), joined back on (schema, table, size)
    like the reference's self-join; the maxima are one row per table.
    """
    maxima = chunks.groupBy("hypertable_schema", "hypertable_name").agg(F.max("total_bytes").alias("total_bytes"))
    return chunks.join(maxima, ["hypertable_schema", "hypertable_name", "total_bytes"], "left_semi")


def largest_chunk_one(chunks: DataFrame) -> DataFrame:
    """The single chosen chunk per table: largest, ties by chunk name.

    ``min`` over a struct ordered as (-size, chunk name) is an algebraic
    aggregate, so no table's chunks have to meet in one task; unknown sizes sort
    last.
    """
    cols = [c for c in chunks.columns if c not in ("hypertable_schema", "hypertable_name")]
    rank = F.coalesce(-F.col("total_bytes"), F.lit(2**63 - 1))
    best = F.min(F.struct(rank.alias("_r"), F.col("chunk_name").alias("_n"), *[F.col(c) for c in cols])).alias("_b")
    out = chunks.groupBy("hypertable_schema", "hypertable_name").agg(best)
    return out.select("hypertable_schema", "hypertable_name", *[F.col("_b." + c).alias(c) for c in cols]).select(*chunks.columns)


def with_qualified_name(hypertables: DataFrame) -> DataFrame:
    return hypertables.withColumn("qualified_name", qualified_name(F.col("hypertable_schema"), F.col("hypertable_name")))

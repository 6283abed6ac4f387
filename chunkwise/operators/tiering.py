"""Tiering (T1-T3) and the stored chunk layout.

Stored layout of a sample table: Parquet partitioned by ``metric / chunk / node``
where ``chunk`` names start and end of the chunk's time range, so a chunk of any
width is exactly one directory per node, chunks of different widths never share one,
and partition pruning is chunk exclusion. The folder names are the interval index of the
layout: ``stored_chunks`` lists it without reading a row, and a move searches it for the
folders that its time ranges touch.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import materialize
from .chunks import largest_chunk_one
from .layout import MAX_RECORDS_PER_FILE, ascending, masked_sort_keys

KEY = ["hypertable_schema", "hypertable_name"]
LAYOUT = ["metric", "chunk", "node"]


# --- stored layout ------------------------------------------------------------------


_STAMP = "yyyyMMdd'T'HHmmss"


def chunk_label(range_start: Column, range_end: Column) -> Column:
    """Folder name of the chunk with this time range; text that no reader takes for a number or date."""
    return F.concat(F.lit("c"), F.date_format(range_start, _STAMP), F.lit("_"), F.date_format(range_end, _STAMP))


def _stamp(label: Column, at: int) -> Column:
    known = label.rlike(r"^c[0-9]{8}T[0-9]{6}_[0-9]{8}T[0-9]{6}$")
    return F.when(known, F.to_timestamp_ntz(F.substring(label, at, 15), F.lit(_STAMP)))


def chunk_start(label: Column) -> Column:
    """Start of a folder's time range; null for a name that tells none."""
    return _stamp(label, 2)


def chunk_end(label: Column) -> Column:
    return _stamp(label, 18)


def _write_layout(rows: DataFrame, path: str, compression: str) -> None:
    """Dynamic overwrite: a rerun replaces only the chunks it writes."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(*LAYOUT)
        .parquet(path)
    )


def store_samples(samples: DataFrame, path: str, compression: str = "zstd", every: str = "1 day") -> None:
    """Write samples in the chunk layout. Rows are range-partitioned on (layout, ts,
    series) so a hot chunk, and one instant with very many rows, are split over
    several tasks and files."""
    spark = samples.sparkSession
    # writer parallelism = shuffle partitions (size it with session.cluster_conf);
    # adaptive coalescing could only merge them and would serialise small writes
    nparts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    window = F.window("ts", every)
    rows = samples.withColumn("chunk", chunk_label(window["start"], window["end"]))
    keys = [*LAYOUT, "ts", *[c for c in ("series_id",) if c in samples.columns]]
    _write_layout(rows.repartitionByRange(nparts, *keys).sortWithinPartitions(*keys), path, compression)


def chunk_files(spark: SparkSession, path: str) -> DataFrame:
    """Real bytes and file count per stored chunk directory.

    ``binaryFile`` with only ``path`` and ``length`` selected lists files without
    reading their content; one row per file, grouped by the partition columns.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "length", *LAYOUT)
    )
    return files.groupBy(*LAYOUT).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").cast("long").alias("file_bytes")
    )


def stored_chunks(spark: SparkSession, path: str) -> DataFrame | None:
    """The interval index of a stored layout: ``metric, chunk, node, range_start, range_end,
    n_files, file_bytes`` of every folder, from the file listing alone. None for rows that
    aren't stored in such folders."""
    if not set(LAYOUT) <= set(spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).columns):
        return None
    return chunk_files(spark, path).withColumns({"range_start": chunk_start(F.col("chunk")), "range_end": chunk_end(F.col("chunk"))})


def touched_chunks(index: DataFrame | None, plan: DataFrame) -> DataFrame:
    """The stored folders (any, without an index) whose time range meets that of a planned chunk, of any width, with
    the plan's range (``_from``, ``_to``), the folder that it gets and its reorder columns."""
    wanted = plan.select(
        F.col("hypertable_name").alias("metric"), F.col("node_name").alias("node"), F.col("range_start").alias("_from"), F.col("range_end").alias("_to"),
        chunk_label(F.col("range_start"), F.col("range_end")).alias("_chunk"), ascending(F.col("reorder_columns")).alias("_order"),
    )
    if index is None:
        return wanted
    # a folder that tells no range may hold any row
    meets = F.coalesce((F.col("range_start") < F.col("_to")) & (F.col("_from") < F.col("range_end")), F.lit(True))
    return index.select(*LAYOUT, "range_start", "range_end").join(wanted, ["metric", "node"]).where(meets).drop("range_start", "range_end")


# --- move plan ------------------------------------------------------------------------


def attached_tables(hypertables: DataFrame, attachments: DataFrame, tier: str) -> DataFrame:
    """Only tables attached to the target tier may move."""
    att = attachments.filter(F.col("tier") == tier)
    shared = [c for c in KEY if c in att.columns]  # attachments may name the schema as well
    return hypertables.select(*KEY).join(att.select(*shared), shared, "left_semi").withColumn("tier", F.lit(tier))


def move_plan(
    old_chunks: DataFrame,
    hypertables: DataFrame,
    indexes: DataFrame,
    attachments: DataFrame,
    tables: Iterable[str],
    schema: str,
    tier: str,
    index_tier: str,
) -> DataFrame:
    """For every listed, attached table its largest old chunk, the destination
    tiers and the reorder index (first index name of the table; null when the
    table has none, the move then keeps the row order).

    ``old_chunks`` is the chunk listing already limited to the age condition.
    """
    names = list(dict.fromkeys(tables))
    listed = old_chunks.filter((F.col("hypertable_schema") == schema) & F.col("hypertable_name").isin(names))
    chosen = largest_chunk_one(listed)
    attached = attached_tables(hypertables, attachments, tier).select(*KEY)
    idx = (
        indexes.filter(F.col("schemaname") == schema)
        .groupBy(F.col("tablename").alias("hypertable_name"))
        .agg(F.min_by(F.struct("indexname", "columns"), F.col("indexname")).alias("_ix"))
    )
    return (
        chosen.join(attached, KEY, "left_semi")
        .join(idx, "hypertable_name", "left")
        .select(
            *KEY,
            "chunk_schema",
            "chunk_name",
            F.concat(F.col("chunk_schema"), F.lit("."), F.col("chunk_name")).alias("chunk"),
            "node_name",
            "range_start",
            "range_end",
            "n_rows",
            F.lit(tier).alias("destination_tier"),
            F.lit(index_tier).alias("index_destination_tier"),
            F.concat(F.lit(schema + "."), F.col("_ix.indexname")).alias("reorder_index"),
            F.col("_ix.columns").alias("reorder_columns"),
        )
    )


def _checksum(columns: list[str]) -> Column:
    """An order-free digest of the rows: two 64-bit hashes of each, added up."""
    hashes = F.xxhash64(*sorted(columns)).cast("decimal(20,0)") + F.hash(*sorted(columns)).cast("decimal(20,0)")
    return F.sum(hashes).cast("string")


def planned_rows(tier: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows of the planned chunks, by table, node and time range, whatever the width of the
    tier's folders; with the folder that the plan's chunk gets and its reorder columns. The
    join is on the partition columns: only the touched folders are read."""
    inside = (F.col("ts") >= F.col("_from")) & (F.col("ts") < F.col("_to"))
    # always true; partitions are pruned at run time only against a side with a condition
    touched = touched.where(F.col("_from") < F.col("_to"))
    return tier.join(touched, [c for c in LAYOUT if c in touched.columns]).where(inside).withColumn("chunk", F.col("_chunk")).drop("_from", "_to", "_chunk")


def move_chunks(spark: SparkSession, hot_path: str, cold_path: str, plan: DataFrame, compression: str = "zstd") -> DataFrame:
    """Rewrite the planned chunks on the cold tier, sorted by the reorder
    index columns, and report per chunk the planned rows and those on both tiers.

    ``plan`` should be a written table: its size then decides how it is joined. All
    chunks are written in one pass; the sort keys of each index are null for the
    others' rows. The hot copy is never touched: the caller removes it only after
    the returned status shows ``ok``, which needs equal row counts in plan, hot and
    cold tier and equal checksums, for every chunk.
    """
    hot = spark.read.parquet(hot_path)
    data = [c for c in hot.columns if c != "chunk"]
    touched = materialize(touched_chunks(stored_chunks(spark, hot_path), plan), "touched_chunks")
    picked = planned_rows(hot, touched)
    keys = masked_sort_keys(plan.select(ascending(F.col("reorder_columns")).alias("o")), F.col("_order"), data)
    order = [*[F.col(c) for c in LAYOUT], *keys, F.col("ts"), *[F.col(c) for c in ("series_id",) if c in data]]
    nparts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _write_layout(picked.repartitionByRange(nparts, *order).sortWithinPartitions(*order).select(*data, "chunk"), cold_path, compression)

    def tally(rows: DataFrame, side: str) -> DataFrame:
        return rows.groupBy(*LAYOUT).agg(F.count(F.lit(1)).alias(f"rows_{side}"), _checksum(data).alias(f"sum_{side}"))

    wanted = plan.select(F.col("hypertable_name").alias("metric"), chunk_label(F.col("range_start"), F.col("range_end")).alias("chunk"), F.col("node_name").alias("node"), F.col("n_rows").alias("rows_plan"))
    cold = read_chunks(spark, cold_path, plan)
    joined = wanted.join(tally(picked, "hot"), LAYOUT, "left").join(tally(cold, "cold"), LAYOUT, "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("rows_plan", "rows_hot", "rows_cold")]
    same = (F.col("rows_plan") == F.col("rows_hot")) & (F.col("rows_hot") == F.col("rows_cold")) & F.col("sum_hot").eqNullSafe(F.col("sum_cold"))
    return joined.select(*LAYOUT, *counts, "sum_hot", "sum_cold").select(*LAYOUT, "rows_plan", "rows_hot", "rows_cold", same.alias("ok"))


def read_chunks(spark: SparkSession, path: str, plan: DataFrame) -> DataFrame:
    """Rows of the planned chunks on the tier that they were moved to (semi join on the
    partition columns; dynamic partition pruning applies when the plan is small)."""
    keys = plan.select(F.col("hypertable_name").alias("metric"), chunk_label(F.col("range_start"), F.col("range_end")).alias("chunk"), F.col("node_name").alias("node"))
    schema = spark.read.parquet(path).schema if _has_files(spark, path) else None
    if schema is None:
        return spark.createDataFrame([], "metric string, chunk string, node string, ts timestamp_ntz")
    return spark.read.schema(schema).parquet(path).join(keys, LAYOUT, "left_semi")


def _has_files(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(target)) and bool(spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path).select("path").head(1))

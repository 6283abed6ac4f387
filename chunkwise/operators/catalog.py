"""C1 and S3 kept up to date from changed files only.

The state is a table of partial chunk sums by file: (file, modification time, size, metric,
node, bucket, rows, payload bytes). A refresh lists the files, which reads no row, keeps the
sums of files that are as they were, drops those of files that are gone, and aggregates only
the new and changed ones. Adding a chunk, rewriting it under new file names and dropping it
are all changes of files, so none of them needs to be announced. The catalog is the sum over
the state, whose size depends on files and chunks, not on rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CHUNK_SCHEMA, DEFAULT_SCHEMA, materialize
from ..sources.readers import drop_folder, path_exists
from ..sources.versions import claim_version, list_versions, version_number
from .chunks import chunk_groups, chunks_from_groups
from .tiering import LAYOUT

FILE = ["file_path", "file_modification_time", "file_size"]
STATE_SCHEMA = (
    "file_path string, file_modification_time timestamp, file_size long, metric string, node string, "
    "w struct<start: timestamp_ntz, end: timestamp_ntz>, n_rows long, toast_bytes long, every string"
)
KEPT_VERSIONS = 2  # the newest, and the one before for readers that have it open


@dataclass
class CatalogRefresh:
    """What a refresh found: the catalog, the files that it read, and how many files of the
    earlier state were kept and dropped."""

    chunks: DataFrame
    files_read: list[str]
    n_kept: int
    n_dropped: int


def _listed_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, file_path, file_modification_time, file_size) of every file; no content is read."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "path string, file_path string, file_modification_time timestamp, file_size long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", *[F.col(f"_metadata.{c}").alias(c) for c in FILE])


def _read_files(spark: SparkSession, path: str, glob: str, files: list[str] | None) -> DataFrame:
    """Rows of the files; of all files under the path without a list. Folder names stay text."""
    schema = spark.read.option("pathGlobFilter", glob).parquet(path).schema
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name in LAYOUT else f.dataType) for f in schema])
    reader = spark.read.schema(schema).option("pathGlobFilter", glob).option("basePath", path)
    return reader.parquet(path) if files is None else reader.parquet(*files)


def _partial_sums(rows: DataFrame, every: str, to_samples: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    samples = rows if to_samples is None else to_samples(rows)
    return chunk_groups(samples.withColumn("file_path", F.col("_metadata.file_path")), every, "file_path")


def read_state(spark: SparkSession, state: str, versions: list[str] | None = None) -> DataFrame:
    """Partial chunk sums by file, as of the newest version; empty before the first refresh.
    A file without rows that C1 counts has one row with a null bucket."""
    versions = list_versions(spark, state) if versions is None else versions
    return spark.read.schema(STATE_SCHEMA).parquet(versions[-1]) if versions else spark.createDataFrame([], STATE_SCHEMA)


def read_catalog(
    spark: SparkSession, state: str, every: str = "1 day", schema: str = DEFAULT_SCHEMA, chunk_schema: str = CHUNK_SCHEMA
) -> DataFrame:
    """The chunk inventory (C1) as of the last refresh; no sample is read."""
    return _chunks(read_state(spark, state), every, schema, chunk_schema)


def _chunks(state: DataFrame, every: str, schema: str, chunk_schema: str) -> DataFrame:
    sums = state.where("w IS NOT NULL").groupBy("metric", "node", "w").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("toast_bytes").alias("toast_bytes")
    )
    return chunks_from_groups(sums, every, schema, chunk_schema)


def refresh_catalog(
    spark: SparkSession,
    path: str,
    state: str,
    every: str = "1 day",
    to_samples: Callable[[DataFrame], DataFrame] | None = None,
    schema: str = DEFAULT_SCHEMA,
    chunk_schema: str = CHUNK_SCHEMA,
    glob: str = "*.parquet",
    attempts: int = 20,
) -> CatalogRefresh:
    """Bring the stored catalog at ``state`` up to date with the sample files under the folder
    ``path`` and return it; equal to a full C1 over the files.

    A file counts as changed if its name, modification time or size is new. What is read is
    named to the scan as files (their names pass the driver, as for any scan of files); the
    first refresh reads the folder. The new state is committed as a version: a refresh that
    loses it to another one starts again from the winner's. A job that fails leaves the
    state as it was, and a file that changes while it is read is read again next time, since
    the state has its earlier modification time. ``to_samples`` maps raw rows to samples. A
    null ``ts`` is in no chunk; a folder that is empty or missing gives an empty catalog.
    """
    for _ in range(attempts):
        versions = list_versions(spark, state)
        before = read_state(spark, state, versions)
        if before.where(F.col("every") != every).head(1):
            raise ValueError(f"{state} holds chunks of another interval than {every!r}")
        listed = materialize(_listed_files(spark, path, glob), "listed_files")
        known = materialize(before.select(*FILE).distinct(), "known_files")
        changed = materialize(listed.join(known, FILE, "left_anti"), "changed_files")
        same = known.join(listed, FILE, "left_semi")
        n_kept, n_dropped = same.count(), known.join(listed, "file_path", "left_anti").count()
        files = [r["path"] for r in changed.select("path").toLocalIterator()]
        if versions and not files and not n_dropped:
            return CatalogRefresh(read_catalog(spark, state, every, schema, chunk_schema), [], n_kept, 0)
        after = before.join(same, FILE, "left_semi")
        if files:
            sums = _partial_sums(_read_files(spark, path, glob, files if versions else None), every, to_samples)
            after = after.unionByName(changed.drop("path").join(sums, "file_path", "left").withColumn("every", F.lit(every)))
        aside = f"{state.rstrip('/')}/_aside_{uuid.uuid4().hex}"
        after.write.parquet(aside)
        if claim_version(spark, aside, state, version_number(versions) + 1):
            for old in versions[: 1 - KEPT_VERSIONS]:
                drop_folder(spark, old)
            return CatalogRefresh(read_catalog(spark, state, every, schema, chunk_schema), files, n_kept, n_dropped)
        drop_folder(spark, aside)
    raise RuntimeError(f"no version of {state} could be committed in {attempts} attempts: other refreshes came first each time")

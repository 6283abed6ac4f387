"""J4's stored dictionary of a target, safe for runs that allocate at the same time.

A target folder holds (labels, series_id) as Parquet. Ids created later are committed as
numbered versions in ``_added``: a run that read version n writes its rows aside and
moves them to n + 1 by a rename that fails if n + 1 exists. So of two runs that read the
same version one commits; the other reads again and allocates above the winner's ids.
The file system's rename must be atomic, as on HDFS or a local disk.

Committed rows are then copied into the folder itself, for readers that open it as a plain
table. Allocation reads both and takes equal rows once, so a run that ends between the two
steps loses no id.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..config import materialize
from ..operators.series import get_or_create_series
from .readers import drop_folder, path_exists
from .versions import claim_version, list_versions, version_number

TARGET_SCHEMA = "labels string, series_id long"


def target_versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the committed versions, oldest first."""
    return list_versions(spark, f"{path.rstrip('/')}/_added")


def read_target(spark: SparkSession, path: str, versions: list[str] | None = None) -> DataFrame:
    """The target's stored (labels, series_id) with all ids created so far, or up to the
    given versions; empty before the first run."""
    versions = target_versions(spark, path) if versions is None else versions
    if not path_exists(spark, path):
        return spark.createDataFrame([], TARGET_SCHEMA)
    base = spark.read.schema(TARGET_SCHEMA).parquet(path)  # names that start with _ aren't read here
    return base.unionByName(spark.read.schema(TARGET_SCHEMA).parquet(*versions)).distinct() if versions else base


def _claim(spark: SparkSession, aside: str, path: str, version: int) -> bool:
    """Make the rows written aside version ``version``; False if another run has it."""
    return claim_version(spark, aside, f"{path.rstrip('/')}/_added", version)


def _publish(created: DataFrame, path: str) -> None:
    """Add the rows to the folder, file by file: runs that write into it at the same time
    share no temporary folder."""
    spark = created.sparkSession
    aside = f"{path.rstrip('/')}/_aside_{uuid.uuid4().hex}"
    created.write.parquet(aside)
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(aside)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for entry in fs.listStatus(folder):
        name = entry.getPath().getName()
        if name.endswith(".parquet") and not fs.rename(entry.getPath(), hadoop.Path(path, name)):
            raise RuntimeError(f"{name} could not be moved into {path}")
    drop_folder(spark, aside)


def allocate_series(spark: SparkSession, labels: DataFrame, path: str, attempts: int = 20) -> DataFrame:
    """J4 against a stored target: the mapping (labels, series_id, created), with the
    created ids committed to the target before it is returned.

    Invalid label texts get no id and a label set that is already there keeps its own.
    A run that loses a version to another tries again from what the winner left.
    """
    wanted = materialize(labels.select("labels").distinct(), "wanted")
    for _ in range(attempts):
        versions = target_versions(spark, path)
        mapping, _ = get_or_create_series(wanted, read_target(spark, path, versions))
        mapping = materialize(mapping, "mapping")
        created = mapping.filter("created").select("labels", "series_id")
        if not created.head(1):
            return mapping
        aside = f"{path.rstrip('/')}/_aside_{uuid.uuid4().hex}"
        created.write.parquet(aside)
        if _claim(spark, aside, path, version_number(versions) + 1):
            _publish(created, path)
            return mapping
        drop_folder(spark, aside)
    raise RuntimeError(f"no version of {path} could be committed in {attempts} attempts: other runs came first each time")

"""Numbered versions of a stored table, committed by compare-and-swap.

A folder holds version folders named by number. A writer puts its rows aside and moves
them to the next number by a rename that fails if the number exists, so of two writers
that started from one version a single one commits. The file system's rename must be
atomic, as on HDFS or a local disk.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from .readers import path_exists


def list_versions(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the committed versions, oldest first; none for a missing folder."""
    if not path_exists(spark, folder):
        return []
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    entries = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(e.getPath().toString() for e in entries if e.getPath().getName().isdigit())


def version_number(versions: list[str]) -> int:
    """Number of the newest version; 0 without one."""
    return int(versions[-1].rsplit("/", 1)[-1]) if versions else 0


def claim_version(spark: SparkSession, aside: str, folder: str, version: int) -> bool:
    """Make the rows written aside version ``version``; False if another run has it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(folder)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target.getFileSystem(conf).mkdirs(target)
    context = hadoop.FileContext.getFileContext(target.toUri(), conf)
    flags = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    flags[0] = getattr(hadoop, "Options$Rename").NONE
    try:
        context.rename(hadoop.Path(aside), hadoop.Path(target, f"{version:012d}"), flags)
    except Py4JJavaError as e:
        name = e.java_exception.getClass().getSimpleName()
        if name == "FileAlreadyExistsException" or path_exists(spark, f"{target.toString()}/{version:012d}"):
            return False
        raise
    return True

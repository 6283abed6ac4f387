"""Sources (S1, S2, S4, S6).

Connection options are passed in; nothing is opened at import time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import materialize

# JDBC options understood by S1; partitioned reads need all four bounds.
_JDBC_PARTITION_KEYS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def read_table(spark: SparkSession, spec: Mapping) -> DataFrame:
    """Open a table from a spec.

    ``{"format": "parquet", "path": ...}`` (default) or
    ``{"format": "jdbc", "url": ..., "dbtable": ..., "partitionColumn": ...,
    "lowerBound": ..., "upperBound": ..., "numPartitions": ..., "fetchsize": ...}``;
    an optional ``"where"`` SQL predicate is applied on top (pushed to the scan
    where the source supports it).
    """
    spec = dict(spec)
    fmt = spec.pop("format", "parquet")
    where = spec.pop("where", None)
    columns = spec.pop("columns", None)
    if fmt == "jdbc":
        present = [k for k in _JDBC_PARTITION_KEYS if k in spec]
        if present and len(present) != len(_JDBC_PARTITION_KEYS):
            raise ValueError(f"partitioned JDBC read needs all of {_JDBC_PARTITION_KEYS}")
        spec.setdefault("fetchsize", "10000")
        reader = spark.read.format("jdbc")
        for k, v in spec.items():
            reader = reader.option(k, str(v))
        df = reader.load()
    else:
        path = spec.pop("path")
        reader = spark.read.format(fmt)
        for k, v in spec.items():
            reader = reader.option(k, str(v))
        df = reader.load(path)
    if where:
        df = df.filter(F.expr(where))
    if columns:
        df = df.select(*columns)
    return df


def read_samples(spark: SparkSession, spec: Mapping, to_samples=None) -> DataFrame:
    """S1 for sample tables: open by spec, then map to the canonical samples
    columns with ``to_samples`` (e.g. :func:`chunkwise.model.samples_from_events`)."""
    df = read_table(spark, spec)
    return to_samples(df) if to_samples is not None else df


def jdbc_options(url: str, table: str, *, user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                 partitions: int | None = None, fetchsize: int = 10000) -> dict:
    """Build an S1 JDBC spec (credentials are passed by the caller)."""
    spec = {"format": "jdbc", "url": url, "dbtable": table, "fetchsize": fetchsize}
    if user is not None:
        spec["user"] = user
    if password is not None:
        spec["password"] = password
    if partition_column is not None:
        spec.update(partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions)
    return spec


def read_nodes(spark: SparkSession, specs: Mapping[str, Mapping], node_col: str = "node") -> DataFrame:
    """The same table on each data node, read in parallel as one union
    with a literal node column."""
    if not specs:
        raise ValueError("no node specs")
    parts = [read_table(spark, spec).withColumn(node_col, F.lit(node)) for node, spec in specs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_nodes_jdbc(spark: SparkSession, url: str, table: str, node_predicates: Mapping[str, str],
                    properties: Mapping[str, str] | None = None, node_col: str = "node") -> DataFrame:
    """S2 when the nodes' data sits behind one server: a single JDBC read with one
    partition per predicate, tagged with the node the predicate selects."""
    nodes = list(node_predicates)
    tagged = [f"({node_predicates[n]})" for n in nodes]
    df = spark.read.jdbc(url, table, predicates=tagged, properties=dict(properties or {}))
    node = F.lit(None).cast("string")
    for n in reversed(nodes):
        node = F.when(F.expr(node_predicates[n]), F.lit(n)).otherwise(node)
    return df.withColumn(node_col, node)


def metrics_dictionary(samples: DataFrame) -> DataFrame:
    """``metrics(metric_id, metric, n_samples)``: ids in md5-bucket order of the name, and
    the metric's samples; one pass over the samples, written once."""
    from ..operators.numbering import hash_ordered_ids

    per_metric = materialize(samples.groupBy("metric").agg(F.count(F.lit(1)).alias("n_samples")), "metrics")
    return hash_ordered_ids(per_metric.where("metric IS NOT NULL"), "metric", "metric_id", start=1)


def metric_filter(samples: DataFrame, metrics: DataFrame, names: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """Metric names -> ids, and only those metrics' samples.

    Returns ``(selected_samples, status)``; ``status`` has one row per requested
    name: ``metric_id`` (null when unknown), ``metric``, ``n_samples``.
    The name list is a literal parameter, so it is a literal IN filter (pushed
    to the scan) rather than a join.
    """
    names = list(dict.fromkeys(names))
    if not names:
        raise ValueError("empty metric list")
    selected = samples.filter(F.col("metric").isin(names))
    wanted = samples.sparkSession.createDataFrame([(n,) for n in names], "metric string")
    if "n_samples" not in metrics.columns:
        metrics = metrics.join(selected.groupBy("metric").agg(F.count(F.lit(1)).alias("n_samples")), "metric", "left")
    status = (
        wanted.join(metrics, "metric", "left")
        .select("metric_id", "metric", F.coalesce("n_samples", F.lit(0)).cast("long").alias("n_samples"))
    )
    return selected, status


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


SNAPSHOT_SCHEMA = "series_id long, labels string, metric string"


def _metric_folder(spark: SparkSession, path: str, metric: str) -> str:
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(metric)
    return f"{path.rstrip('/')}/metric={escaped}"


def metric_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the ``metric=`` folders under a path, which may be missing."""
    if not path_exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    entries = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    return [e.getPath().getName() for e in entries if e.isDirectory() and e.getPath().getName().startswith("metric=")]


def drop_folder(spark: SparkSession, path: str) -> bool:
    """Remove a run's folder (a snapshot, written lines) once it isn't needed."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))


def clear_metrics(spark: SparkSession, path: str, metrics: Iterable[str]) -> None:
    """Remove the ``metric=`` folders of the listed metrics."""
    for m in metrics:
        drop_folder(spark, _metric_folder(spark, path, m))


def drop_snapshot(spark: SparkSession, path: str, metrics: Iterable[str] | None = None) -> None:
    """S6's counterpart, for the caller after a successful run: drop the snapshot, or
    the listed metrics' part of it."""
    if metrics is None:
        drop_folder(spark, path)
    else:
        clear_metrics(spark, path, metrics)


def snapshot_series(spark: SparkSession, series: DataFrame, path: str, metrics: Iterable[str] | None = None) -> DataFrame:
    """Materialise the label dictionary of some (or all) metrics once.

    Partitions ``metric=...`` that already exist are kept as they are (create if
    absent, fill only if empty). Missing ones are written aside and each is moved in
    by a rename, so a crash leaves no half-written one. Returns the snapshot read back
    (empty for unknown metrics). :func:`drop_snapshot` removes it.
    """
    wanted = series if metrics is None else series.filter(F.col("metric").isin(list(metrics)))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    fs.mkdirs(folder)
    have = spark.read.schema(SNAPSHOT_SCHEMA).parquet(path).select("metric").distinct()
    aside = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}_aside_{uuid.uuid4().hex}")
    wanted.select("series_id", "labels", "metric").join(have, "metric", "left_anti").write.partitionBy("metric").parquet(aside.toString())
    for entry in fs.listStatus(aside):
        if entry.isDirectory():
            fs.rename(entry.getPath(), jvm.org.apache.hadoop.fs.Path(folder, entry.getPath().getName()))
    fs.delete(aside, True)
    snap = spark.read.schema(SNAPSHOT_SCHEMA).parquet(path)
    if metrics is not None:
        snap = snap.filter(F.col("metric").isin(list(metrics)))
    return snap.select("series_id", "metric", "labels")

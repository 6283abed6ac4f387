"""Series dictionary, label identity and id mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import canonical_labels, valid_labels
from .numbering import number_missing


def samples_with_labels(samples: DataFrame, series: DataFrame) -> DataFrame:
    """Inner join on series id; samples without labels drop.

    The dictionary is much smaller than the samples; adaptive execution
    measures it at run time and broadcasts it below the broadcast threshold,
    otherwise a shuffle join runs with skewed partitions split.
    """
    s = samples.drop("labels") if "labels" in samples.columns else samples
    return s.join(one_label_set(series), "series_id")


def one_label_set(series: DataFrame) -> DataFrame:
    """``(series_id, labels)`` with one row per id, so that a join on it doubles nothing:
    labels that differ in key order only are one set, of others the smallest counts."""
    labels = F.coalesce(canonical_labels("labels"), F.col("labels"))
    return series.groupBy("series_id").agg(F.min(labels).alias("labels"))


def series_ids(samples: DataFrame, metric: str | None = None) -> DataFrame:
    """Distinct series ids present in the data (of one metric)."""
    s = samples if metric is None else samples.filter(F.col("metric") == metric)
    return s.select("series_id").distinct()


def get_or_create_series(labels: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Label set -> id on the target cluster.

    ``labels`` has a ``labels`` column (any key order); ``target`` is the target's
    ``(labels, series_id)``. Existing label sets keep their ids; new ones get
    ids above the target's maximum, numbered once per distinct label set in a
    fixed order (md5 bucket, labels) without a single-task sort.

    A label set that the target holds more than once keeps its smallest id there.
    Invalid label texts get no id: :func:`rejected_labels` lists them.

    Returns ``(mapping, new_target)``: mapping ``(labels, series_id, created)``
    for every requested label set, and the target with the created rows added.
    """
    wanted = labels.where(valid_labels("labels")).select(canonical_labels("labels").alias("labels")).distinct()
    tgt = target.where(valid_labels("labels")).groupBy(canonical_labels("labels").alias("labels")).agg(F.min(F.col("series_id").cast("long")).alias("series_id"))
    found = wanted.join(tgt, "labels", "left")
    mapping = number_missing(found, "labels", "series_id", target.agg(F.max(F.col("series_id").cast("long"))))
    mapping = mapping.withColumn("created", F.col("_new")).drop("_new")
    new_target = tgt.unionByName(mapping.filter("created").select("labels", "series_id"))
    return mapping, new_target


def rejected_labels(labels: DataFrame) -> DataFrame:
    """The distinct label texts that are no label set."""
    return labels.where(~valid_labels("labels")).select("labels").distinct()


def id_map(series: DataFrame, mapping: DataFrame) -> DataFrame:
    """Old series id -> new series id, at dictionary size."""
    return one_label_set(series).join(
        mapping.select("labels", F.col("series_id").alias("new_series_id")), "labels"
    ).select("series_id", "new_series_id")


def remap_samples(samples: DataFrame, series: DataFrame, mapping: DataFrame) -> DataFrame:
    """Sample rows with target ids ``(ts, value, new_series_id, metric)``.

    The labels join runs on the dictionary; the samples take a single join on
    the old id.
    """
    return remap_with(samples, id_map(series, mapping))


def remap_with(samples: DataFrame, ids: DataFrame) -> DataFrame:
    """J5 with a prepared ``(series_id, new_series_id)`` map."""
    return samples.select("metric", "series_id", "ts", "value").join(ids, "series_id").select(
        "metric", "ts", "value", "series_id", "new_series_id"
    )

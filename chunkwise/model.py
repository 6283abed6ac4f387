"""Data model: canonical sample rows and the dictionaries derived from them.

``samples(metric, series_id, user_id, ts, value, node, labels, payload)`` is
one long table; ``metric`` is a column (one hypertable per metric), not one
table per metric.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.labels import canonical_labels
from .functions.scalar import md5_int

N_NODES = 4

SAMPLE_COLUMNS = ["metric", "series_id", "user_id", "ts", "value", "node", "labels", "payload"]


def require_samples(df: DataFrame, needed=("metric", "series_id", "ts", "value", "node", "labels", "payload")) -> DataFrame:
    """Fail early, with the missing names, when a table is not shaped as samples."""
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"not a samples table, missing columns {missing}; map it with a samples_from_* function")
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def node_of(key: Column) -> Column:
    """Data node of a series: 'dn1' .. 'dn4'."""
    return F.concat(F.lit("dn"), (F.lit(1) + key % N_NODES).cast("string"))


def series_id_of(labels: Column) -> Column:
    """Source-cluster series id: first 15 hex digits of md5(labels) as bigint."""
    return md5_int(labels, 15)


def samples_from_events(events: DataFrame) -> DataFrame:
    """Canonical samples view of the ``events`` table (FIXTURES.md section 1)."""
    k = F.get_json_object("props", "$.k").cast("int")
    labels = F.to_json(
        F.named_struct(
            F.lit("__name__"), F.col("event_type"),
            F.lit("shard"), (F.col("user_id") % N_NODES).cast("string"),
            F.lit("user"), F.col("user_id").cast("string"),
        )
    )
    return events.select(
        F.col("event_type").alias("metric"),
        series_id_of(labels).alias("series_id"),
        F.col("user_id"),
        F.col("ts"),
        F.when(k == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        node_of(F.col("user_id")).alias("node"),
        labels.alias("labels"),
        F.col("props").alias("payload"),
    )


def samples_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """A second, multi-year sample table: one series per supplier."""
    labels = F.to_json(
        F.named_struct(
            F.lit("__name__"), F.lit("lineitem_price"),
            F.lit("supplier"), F.col("l_suppkey").cast("string"),
        )
    )
    return lineitem.select(
        F.lit("lineitem_price").alias("metric"),
        series_id_of(labels).alias("series_id"),
        F.col("l_suppkey").alias("user_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("ts"),
        F.col("l_extendedprice").alias("value"),
        node_of(F.col("l_suppkey")).alias("node"),
        labels.alias("labels"),
        F.concat_ws("|", "l_returnflag", "l_linestatus", F.col("l_orderkey").cast("string")).alias("payload"),
    )


def load_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples_from_events(table(spark, sf_dir, "events"))


def series_dictionary(samples: DataFrame) -> DataFrame:
    """``series(series_id, metric, labels)``: one row per series id, labels in canonical
    form (invalid text as it is). The first grouping collapses every series map-side, so a
    hot series costs one row per task in the shuffle; what follows has dictionary
    size. Ids whose labels truly differ get the smallest (see :func:`label_conflicts`).
    """
    # a plain distinct below min() is taken out by the optimizer, and every sample's labels
    # would be parsed and sorted; the condition on the count keeps the grouping
    rows = samples.groupBy("series_id", "metric", "labels").agg(F.count(F.lit(1)).alias("_n")).where("_n > 0")
    labels = F.coalesce(canonical_labels("labels"), F.col("labels"))
    return rows.groupBy("series_id").agg(F.min("metric").alias("metric"), F.min(labels).alias("labels"))


def label_conflicts(samples: DataFrame) -> DataFrame:
    """``(series_id, n_label_sets)`` of the ids that carry more than one label set."""
    rows = samples.select("series_id", "labels").distinct()
    counted = rows.groupBy("series_id").agg(F.countDistinct(F.coalesce(canonical_labels("labels"), F.col("labels"))).alias("n_label_sets"))
    return counted.where("n_label_sets > 1")


def attachments_df(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, "hypertable_name string, tier string")


def indexes_df(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, "schemaname string, tablename string, indexname string, columns array<string>")

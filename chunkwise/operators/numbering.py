"""Deterministic dense numbering without a single-task global sort.

``row_number() over (order by key)`` sorts every key in one task. Here the key
space is cut into 4,096 md5 buckets: count per bucket, a running sum over the
(at most 4,096 + 1) counts gives each bucket its offset, and ``row_number`` runs
inside each bucket. The result equals
``start - 1 + row_number() over (order by substr(md5(key), 1, 3), key)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import materialize

BUCKET_HEX_DIGITS = 3  # 16^3 = 4,096 buckets


def md5_bucket(key):
    return F.substring(F.md5(key), 1, BUCKET_HEX_DIGITS)


def _offsets(counts: DataFrame) -> DataFrame:
    """(_bk, _n) -> (_bk, _off = sum of _n over earlier buckets). At most 4,097
    rows, so the single-partition window and the broadcast are bounded."""
    running = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(counts.select("_bk", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_off")))


def hash_ordered_ids(df: DataFrame, key: str, out: str, start: int = 1) -> DataFrame:
    """Adds ``out`` = dense number of ``key`` from ``start`` (keys must be
    distinct in ``df``)."""
    keyed = df.withColumn("_bk", md5_bucket(F.col(key)))
    counts = keyed.groupBy("_bk").agg(F.count(F.lit(1)).alias("_n"))
    ranked = keyed.withColumn("_rn", F.row_number().over(Window.partitionBy("_bk").orderBy(key)))
    number = F.lit(start - 1) + F.col("_off") + F.col("_rn")
    return ranked.join(_offsets(counts), "_bk").withColumn(out, number.cast("long")).drop("_bk", "_off", "_rn")


def key_ordered_ids(df: DataFrame, key: str, out: str, start: int = 1) -> DataFrame:
    """Adds ``out`` = dense number of ``key`` in key order, from ``start``:
    ``start - 1 + row_number() over (order by key)``. Keys must be distinct.

    A range-partitioned copy is written once, so that partition numbers stay what
    they are; rows are counted per partition, and the running sum over those counts
    (one row per partition) gives each partition its offset.
    """
    rows = materialize(df.repartitionByRange(F.col(key)).withColumn("_bk", F.spark_partition_id()), "by_key")
    counts = rows.groupBy("_bk").agg(F.count(F.lit(1)).alias("_n"))
    ranked = rows.withColumn("_rn", F.row_number().over(Window.partitionBy("_bk").orderBy(key)))
    number = F.lit(start - 1) + F.col("_off") + F.col("_rn")
    return ranked.join(_offsets(counts), "_bk").withColumn(out, number.cast("long")).drop("_bk", "_off", "_rn")


def number_missing(df: DataFrame, key: str, id_col: str, base: DataFrame) -> DataFrame:
    """Fill null ``id_col`` values with new ids above ``base`` (a one-row,
    one-column maximum; null counts as 0) in one pass: rows keep their id, rows
    without one are numbered in (md5 bucket, key) order. Adds a boolean ``_new``.

    The base enters the running sum as an extra leading row, so no cross join
    is needed to add it.
    """
    keyed = df.withColumn("_bk", md5_bucket(F.col(key))).withColumn("_new", F.col(id_col).isNull())
    counts = keyed.groupBy("_bk").agg(F.count(F.when(F.col("_new"), F.lit(1))).alias("_n"))
    base_row = base.select(F.lit("").alias("_bk"), F.coalesce(F.col(base.columns[0]).cast("long"), F.lit(0)).alias("_n"))
    ranked = keyed.withColumn("_rn", F.row_number().over(Window.partitionBy("_bk", "_new").orderBy(key)))
    new_id = F.when(F.col("_new"), F.col("_off") + F.col("_rn")).otherwise(F.col(id_col))
    return (
        ranked.join(_offsets(counts.unionByName(base_row)), "_bk")
        .withColumn(id_col, new_id.cast("long"))
        .drop("_bk", "_off", "_rn")
    )

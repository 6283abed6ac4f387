"""Samples and dictionary stored together by series, so that their join is local.

Both are bucketed tables on ``(series_id, slot)`` with the same number of buckets: the
rows of a bucket and the labels that they need lie in one task, and a join reads both as
they are, without a shuffle of the samples. A series with more than ``rows_per_slot``
rows is dealt over slots by its rows' content, and its dictionary entry is repeated for
each, so a series that holds a third of all rows spreads over as many buckets.

The shuffle is paid once, when the tables are written; every later join, export or id
mapping of the same samples does without.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import materialize, work_dir
from .series import one_label_set

KEYS = ["series_id", "slot"]


@dataclass(frozen=True)
class StoredSeries:
    """Names of the two bucketed tables in the session's catalog."""

    spark: SparkSession
    samples_table: str
    dictionary_table: str

    @property
    def samples(self) -> DataFrame:
        return self.spark.table(self.samples_table)

    @property
    def dictionary(self) -> DataFrame:
        """(series_id, slot, labels): one row for each slot of a series."""
        return self.spark.table(self.dictionary_table)

    def drop(self) -> None:
        """Forget the tables; their folder goes with the run."""
        for name in (self.samples_table, self.dictionary_table):
            self.spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def slots_of(samples: DataFrame, rows_per_slot: int) -> DataFrame:
    """(series_id, slots): how many slots each series is dealt over. Counted with a map-side
    partial step, so a hot series is one row per task."""
    if rows_per_slot < 1:
        raise ValueError("rows_per_slot must be >= 1")
    counts = samples.where("series_id IS NOT NULL").groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("series_id", F.ceil(F.col("n") / F.lit(rows_per_slot)).cast("int").alias("slots"))


def store_by_series(
    samples: DataFrame, series: DataFrame, buckets: int | None = None, rows_per_slot: int = 1 << 20, path: str | None = None, name: str | None = None
) -> StoredSeries:
    """Write samples and dictionary as bucketed tables under ``path`` (a folder that the
    cluster shares; by default one of the run's work folders).

    Samples without a series id have no labels and aren't stored; series that only one
    side knows are kept on that side. ``labels`` of the samples, if any, are left out:
    the dictionary's count. ``buckets`` defaults to the session's shuffle partitions.
    """
    spark = samples.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = path or work_dir(spark, "stored_series")
    name = name or f"chunkwise_{uuid.uuid4().hex}"
    # written once: its size then decides how it is joined, and hot keys can be split
    slots = materialize(slots_of(samples, rows_per_slot), "slots")
    content = [c for c in samples.columns if c != "labels"]
    dealt = F.pmod(F.xxhash64(*sorted(content)), F.col("slots")).cast("int")
    rows = samples.select(content).join(slots, "series_id").withColumn("slot", dealt).drop("slots")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("slots", F.lit(1)) - 1))
    entries = one_label_set(series).join(slots, "series_id", "left").withColumn("slot", every).select(*KEYS, "labels")

    def write(frame: DataFrame, part: str, order: list[str]) -> str:
        # the same hash as the buckets': one file for each of them
        table = f"{name}_{part}"
        parts = frame.repartition(buckets, *KEYS)
        parts.write.mode("overwrite").option("path", f"{path}/{part}").bucketBy(buckets, *KEYS).sortBy(*order).saveAsTable(table)
        return table

    order = [*KEYS, *(["ts"] if "ts" in content else [])]
    return StoredSeries(spark, write(rows, "samples", order), write(entries, "dictionary", KEYS))


def stored_samples_with_labels(stored: StoredSeries) -> DataFrame:
    """J1 on the stored tables: bucket meets bucket, no row is shuffled."""
    return stored.samples.join(stored.dictionary, KEYS).drop("slot")


def stored_remapped_samples(stored: StoredSeries, mapping: DataFrame) -> DataFrame:
    """J5 on the stored tables: old -> new ids at dictionary size, then a join in which only
    the id table moves to the samples' buckets."""
    wanted = mapping.select("labels", F.col("series_id").alias("new_series_id"))
    ids = stored.dictionary.join(wanted, "labels").select(*KEYS, "new_series_id")
    return stored.samples.join(ids, KEYS).select("metric", "ts", "value", "series_id", "new_series_id")

"""Batches over runs of a key that is cut into slices of the order."""

import datetime as dt
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chunkwise.config import ensure_checkpoint_dir
from chunkwise.operators import batches as B
from chunkwise.operators.slices import slice_bounds, slice_number

SCHEMA = "k string, ts timestamp_ntz, value double, extra int"


def _rows(spark, n=3000):
    """A third of the rows in one key, many at one instant, nulls and NaN everywhere."""
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else (None if i % 7 == 0 else f"k{i % 40}")
        ts = None if i % 101 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=1500 * (0 if i % 5 == 0 else i))
        value = float("nan") if i % 97 == 0 else (None if i % 89 == 0 else float(i * 7919 % n))
        rows.append((key, ts, value, i))
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


ORDER = ["ts", "value", "extra"]


def _by_window(df, size):
    number = F.row_number().over(Window.partitionBy("k").orderBy(*ORDER)) - 1
    return df.withColumn("batch", F.floor(number / size).cast("long"))


def _text(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("size", [1, 7, 400, 10_000])
@pytest.mark.parametrize("per_slice", [60, 1000, 1_000_000])
def test_batches_and_groups_equal_one_window(spark, size, per_slice):
    df = _rows(spark)
    want = _by_window(df, size)
    got = B.with_batches(df, ["k"], ORDER, size, rows_per_slice=per_slice)
    assert got.columns == [*df.columns, "batch"]
    assert _text(got.collect()) == _text(want.collect())
    groups = B.batch_groups(df, ["k"], ORDER, size, per_slice).collect()
    arrays = want.groupBy("k", "batch").agg(F.array_sort(F.collect_list(F.struct(*ORDER))).alias("rows"))
    assert _text(groups) == _text(arrays.collect())


def test_slices_follow_the_order_and_hold_like_numbers(spark):
    df = _rows(spark, 6000).where("k = 'hot'")
    bounds = slice_bounds(df, ORDER, 100)
    cut = df.withColumn("s", slice_number(df, ORDER, bounds))
    w = Window.orderBy(*ORDER)
    assert cut.withColumn("before", F.lag("s").over(w)).where("s < before").count() == 0
    counts = [r["count"] for r in cut.groupBy("s").count().collect()]
    assert len(counts) >= 15 and sum(counts) == 2000 and max(counts) <= 300
    # decided by content: another partitioning gives the same slices
    again = df.repartition(3).withColumn("s", slice_number(df, ORDER, bounds))
    assert _text(again.collect()) == _text(cut.collect())


def test_one_shuffle_of_the_rows_and_no_written_copy(spark):
    df = _rows(spark)
    folder = os.path.join(ensure_checkpoint_dir(spark), "chunkwise")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    got = B.with_batches(df, ["k"], ORDER, 50, rows_per_slice=200)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    got.collect()
    assert (set(os.listdir(folder)) if os.path.isdir(folder) else set()) == before
    assert "Join" not in plan
    executed = got._jdf.queryExecution().executedPlan().toString()
    final = executed.split("== Initial Plan ==")[0]
    # the columns that no key or order names meet one exchange by (key, slice) alone
    moved = [line for line in final.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("_slice" in line and "REPARTITION" not in line for line in moved) <= 2, final


def test_border_parts_share_the_exchange_of_the_rows(spark):
    got = B.batch_groups(_rows(spark), ["k"], ORDER, 50, 200)
    got.collect()
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_empty_table_and_bad_parameters(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert B.with_batches(empty, ["k"], ORDER, 5).collect() == []
    assert B.batch_groups(empty, ["k"], ORDER, 5, 1).collect() == []
    for bad in (lambda: B.with_batches(empty, ["k"], ORDER, 0), lambda: B.with_batches(empty, ["k"], [], 5)):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(ValueError):
        slice_bounds(empty, ORDER, 0)


def test_order_columns_are_computed_once_a_row(spark):
    df = spark.range(300).select(F.md5(F.to_json(F.struct("id"))).alias("k"), (F.col("id") % 7).alias("v"))
    bounds = slice_bounds(df, ["v", "k"], 10)
    cut = df.groupBy(slice_number(df, ["v", "k"], bounds).alias("s")).count()
    plan = cut._jdf.queryExecution().optimizedPlan()
    # md5 of the row stands before the search, not inside it
    before, search = plan.toString().split("aggregate([", 1)
    assert "md5" in before and "md5" not in search
    got = {r["s"]: r["count"] for r in cut.collect()}
    assert sum(got.values()) == 300 and len(got) > 10
    ordered = [r["s"] for r in df.withColumn("s", slice_number(df, ["v", "k"], bounds)).orderBy("v", "k").collect()]
    assert ordered == sorted(ordered)


def test_rows_are_prepared_after_they_are_counted_and_sampled(spark):
    df = _rows(spark)
    known = spark.range(0, 3000, 1, 3).where("id % 11 <> 4").select(F.col("id").cast("int").alias("extra"))
    seen = []

    def prepare(rows):  # a look-up that leaves some rows out
        seen.append(rows.count())
        return rows.join(known, "extra")

    got = B.batch_groups(df, ["k"], ORDER, 7, 60, prepare).collect()
    assert len(seen) == 2 and seen[0] < 1000 and seen[1] == 3000
    want = _by_window(df.where("extra % 11 <> 4"), 7).groupBy("k", "batch")
    assert _text(got) == _text(want.agg(F.array_sort(F.collect_list(F.struct(*ORDER))).alias("rows")).collect())

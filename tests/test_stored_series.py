"""Samples and dictionary stored by series: the join is local, also for a hot series."""

import datetime as dt

import pytest

from chunkwise.operators import series as J
from chunkwise.operators.stored_series import slots_of, store_by_series, stored_remapped_samples, stored_samples_with_labels
from helpers import SAMPLE_SCHEMA


def _samples(spark, n=3000):
    rows = []
    for i in range(n):
        sid = 1 if i % 3 == 0 else 100 + i % 40
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * i)
        rows.append(("hot" if sid == 1 else "m", sid if i % 50 else None, sid, ts, float(i % 97), "dn1", '{"old":"x"}', "p"))
    return spark.createDataFrame(rows, SAMPLE_SCHEMA)


def _series(spark):
    return spark.createDataFrame([(i, f'{{"id":"{i}"}}') for i in (1, *range(100, 130), 999)] + [(1, '{"id":"1"}')], "series_id long, labels string")


@pytest.fixture()
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_join_is_local_and_exact(spark, no_broadcast):
    samples, series = _samples(spark), _series(spark)
    stored = store_by_series(samples, series, buckets=8, rows_per_slot=100)
    got = stored_samples_with_labels(stored)
    want = J.samples_with_labels(samples, series).select(got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = _plan(got)
    assert "Exchange" not in plan and "Join" in plan
    stored.drop()


def test_ids_are_mapped_without_moving_samples(spark, no_broadcast):
    samples, series = _samples(spark), _series(spark)
    mapping = spark.createDataFrame([(f'{{"id":"{i}"}}', i + 5000) for i in (1, *range(100, 125))], "labels string, series_id long")
    stored = store_by_series(samples, series, buckets=8, rows_per_slot=100)
    got = stored_remapped_samples(stored, mapping)
    want = J.remap_samples(samples, series, mapping).select(got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # exchanges stand over the dictionary and the ids alone: none has a sample's columns
    exchanges = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line and "value" in line]
    assert not exchanges


def test_a_hot_series_lies_in_many_buckets(spark):
    samples = _samples(spark)
    stored = store_by_series(samples, _series(spark), buckets=16, rows_per_slot=100)
    slots = {r["series_id"]: r["slots"] for r in slots_of(samples, 100).collect()}
    hot = samples.where("series_id = 1").count()
    assert slots[1] == -(-hot // 100) and all(n == 1 for s, n in slots.items() if s != 1)
    per_file = [r["n"] for r in stored.samples.selectExpr("input_file_name() AS f").groupBy("f").count().withColumnRenamed("count", "n").collect()]
    assert max(per_file) < 0.2 * sum(per_file) and sum(per_file) == samples.where("series_id IS NOT NULL").count()


def test_edges(spark):
    samples, series = _samples(spark, 10), _series(spark)
    with pytest.raises(ValueError):
        slots_of(samples, 0)
    assert stored_samples_with_labels(store_by_series(samples.limit(0), series, buckets=2)).count() == 0
    assert stored_samples_with_labels(store_by_series(samples, series.limit(0), buckets=2)).count() == 0

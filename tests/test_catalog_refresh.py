"""The catalog refreshed from changed files equals a full inventory, and reads only those."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from chunkwise.model import load_samples, samples_from_events, table
from chunkwise.operators.catalog import read_catalog, refresh_catalog
from chunkwise.operators.chunks import chunk_inventory, hypertable_catalog
from chunkwise.operators.tiering import store_samples
from chunkwise.sources.readers import drop_folder
from conftest import SF_SMALL
from helpers import samples_df


def _same(got, want):
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def _full(spark, path):
    return chunk_inventory(spark.read.parquet(path))


SPEC = [("click", "dn1", 1, 3, 20, "abc"), ("click", "dn2", 2, 4, 7, None), ("view", "dn1", 1, 5, 5, "x"), ("odd=%name", "dn1", 1, 5, 3, "é")]


def test_added_rewritten_and_dropped_folders(spark, tmp_dir):
    path, state = f"{tmp_dir}/rows", f"{tmp_dir}/state"
    store_samples(samples_df(spark, SPEC), path)
    first = refresh_catalog(spark, path, state)
    _same(first.chunks, _full(spark, path))
    assert first.n_kept == first.n_dropped == 0 and first.files_read

    store_samples(samples_df(spark, [("click", "dn1", 1, 3, 33, "longer")]), path)  # rewritten
    store_samples(samples_df(spark, [("error", "dn3", 9, 1, 4, "n"), ("odd=%name", "dn1", 2, 1, 2, "n")]), path)  # added
    assert drop_folder(spark, f"{path}/metric=view")  # dropped
    second = refresh_catalog(spark, path, state)
    _same(second.chunks, _full(spark, path))
    folders = {f.split("/rows/")[1].rsplit("/", 1)[0] for f in second.files_read}
    assert {f.split("/")[0] for f in folders} == {"metric=click", "metric=error", "metric=odd%3D%25name"}
    assert all("c20240101T000000" in f for f in folders if f.startswith("metric=click"))
    assert second.n_kept > 0 and second.n_dropped > 0

    third = refresh_catalog(spark, path, state)  # nothing changed: nothing is read
    assert third.files_read == [] and third.n_dropped == 0
    _same(third.chunks, second.chunks)
    _same(read_catalog(spark, state), second.chunks)
    _same(hypertable_catalog(third.chunks), hypertable_catalog(_full(spark, path)))


def test_the_scan_names_changed_files_only(spark, tmp_dir):
    from chunkwise.operators import catalog as K

    path = f"{tmp_dir}/rows"
    store_samples(samples_df(spark, SPEC), path)
    listed = K._listed_files(spark, path, "*.parquet")
    one = [r.path for r in listed.where(F.col("path").contains("metric=view")).collect()]
    rows = K._read_files(spark, path, "*.parquet", one)
    assert len(rows.inputFiles()) == len(one) < listed.count()
    assert {r.metric for r in rows.collect()} == {"view"}


def test_a_file_rewritten_under_its_own_name_is_read_again(spark, tmp_dir):
    path, state = f"{tmp_dir}/rows", f"{tmp_dir}/state"
    events = table(spark, SF_SMALL, "events")
    events.where("user_id % 2 = 0").coalesce(1).write.parquet(f"{path}/a")
    events.where("user_id % 2 = 1").coalesce(1).write.parquet(f"{path}/b")
    glob = f"{path}/*"
    half = chunk_inventory(samples_from_events(spark.read.parquet(glob)))
    for name in ("a", "b"):  # one flat folder of files, as other tools leave them
        for f in os.listdir(f"{path}/{name}"):
            if f.endswith(".parquet"):
                os.makedirs(f"{path}/flat", exist_ok=True)
                os.link(f"{path}/{name}/{f}", f"{path}/flat/{name}.parquet")
    got = refresh_catalog(spark, f"{path}/flat", state, to_samples=samples_from_events)
    _same(got.chunks, half)
    _same(got.chunks, chunk_inventory(load_samples(spark, SF_SMALL)))
    os.utime(f"{path}/flat/a.parquet", (1_700_000_000, 1_700_000_000))
    again = refresh_catalog(spark, f"{path}/flat", state, to_samples=samples_from_events)
    assert [os.path.basename(f) for f in again.files_read] == ["a.parquet"] and again.n_kept == 1
    _same(again.chunks, half)


def test_null_times_empty_files_and_empty_folders(spark, tmp_dir):
    path, state = f"{tmp_dir}/rows", f"{tmp_dir}/state"
    assert refresh_catalog(spark, path, state).chunks.collect() == []  # nothing there yet
    rows = samples_df(spark, [("click", "dn1", 1, 3, 4, "abc")])
    rows.withColumn("ts", F.lit(None).cast("timestamp_ntz")).coalesce(1).write.parquet(path)
    got = refresh_catalog(spark, path, state)
    assert got.chunks.collect() == [] and len(got.files_read) == 1
    assert refresh_catalog(spark, path, state).files_read == []  # known, though in no chunk
    rows.coalesce(1).write.mode("append").parquet(path)
    _same(refresh_catalog(spark, path, state).chunks, chunk_inventory(spark.read.parquet(path)))
    drop_folder(spark, path)
    gone = refresh_catalog(spark, path, state)
    assert gone.chunks.collect() == [] and gone.n_dropped == 2


def test_another_interval_needs_its_own_state(spark, tmp_dir):
    path, state = f"{tmp_dir}/rows", f"{tmp_dir}/state"
    store_samples(samples_df(spark, SPEC), path)
    got = refresh_catalog(spark, path, state, every="6 hours")
    _same(got.chunks, chunk_inventory(spark.read.parquet(path), every="6 hours"))
    with pytest.raises(ValueError, match="another interval"):
        refresh_catalog(spark, path, state)


def test_two_refreshes_at_once_commit_one_after_the_other(spark, tmp_dir):
    path, state = f"{tmp_dir}/rows", f"{tmp_dir}/state"
    store_samples(samples_df(spark, SPEC), path)
    refresh_catalog(spark, path, state)
    store_samples(samples_df(spark, [("click", "dn4", 20, 3, 6, "abc")]), path)
    with ThreadPoolExecutor(2) as pool:
        both = list(pool.map(lambda _: refresh_catalog(spark, path, state), range(2)))
    assert len(both) == 2
    _same(read_catalog(spark, state), _full(spark, path))
    assert read_catalog(spark, state).where(F.col("range_start") == F.lit(dt.datetime(2024, 1, 20))).count() == 1

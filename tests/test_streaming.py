import os

import pyarrow.parquet as pq

from chunkwise.config import work_dir
from chunkwise.model import load_samples
from chunkwise.operators import chunks as C
from chunkwise.streaming.inventory import read_inventory, run_incremental_inventory, stream_events_as_samples

from conftest import SF_SMALL


def test_incremental_inventory_equals_batch(spark):
    src = work_dir(spark, "events_in")
    os.makedirs(src)
    events = pq.read_table(os.path.join(SF_SMALL, "events.parquet"))
    ids = events.column("event_id").to_pylist()
    tbl, ckpt = work_dir(spark, "inv"), work_dir(spark, "ckpt")

    def run():
        run_incremental_inventory(stream_events_as_samples(spark, src, "*.parquet", max_files=1), tbl, ckpt)

    # three arrival waves; every wave touches chunks of every day (late rows)
    for i in range(3):
        wave = events.filter([x % 3 == i for x in ids])
        pq.write_table(wave, os.path.join(src, f"events_{i}.parquet"))
        run()
    got = read_inventory(spark, tbl)
    want = C.chunk_inventory(load_samples(spark, SF_SMALL))
    key = sorted(want.columns)
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))
    # nothing new arrived: a rerun leaves the inventory as it is
    run()
    assert read_inventory(spark, tbl).count() == want.count()


def test_compaction_keeps_inventory(spark):
    src = work_dir(spark, "events_in2")
    os.makedirs(src)
    events = pq.read_table(os.path.join(SF_SMALL, "events.parquet"))
    ids = events.column("event_id").to_pylist()
    tbl, ckpt, out = work_dir(spark, "inv2"), work_dir(spark, "ckpt2"), work_dir(spark, "compact")
    for i in range(2):
        pq.write_table(events.filter([x % 2 == i for x in ids]), os.path.join(src, f"events_{i}.parquet"))
        run_incremental_inventory(stream_events_as_samples(spark, src, "*.parquet", max_files=1), tbl, ckpt)
    from chunkwise.streaming.inventory import compact_inventory

    compacted = compact_inventory(spark, tbl, out)
    key = sorted(compacted.columns)
    want = read_inventory(spark, tbl)
    assert sorted(map(tuple, compacted.select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 1


def test_cli_stream_inventory(spark):
    from chunkwise.__main__ import main

    src = work_dir(spark, "events_in3")
    os.makedirs(src)
    pq.write_table(pq.read_table(os.path.join(SF_SMALL, "events.parquet")), os.path.join(src, "events_0.parquet"))
    tbl, ckpt = work_dir(spark, "inv3"), work_dir(spark, "ckpt3")
    main(["stream-inventory", "--samples", src, "--events", "--out", tbl, "--checkpoint", ckpt, "--glob", "events_*.parquet"])
    assert read_inventory(spark, tbl).count() == C.chunk_inventory(load_samples(spark, SF_SMALL)).count()

import pytest
from pyspark.sql import functions as F

from chunkwise.config import Params, work_dir
from chunkwise.model import (
    attachments_df,
    indexes_df,
    load_samples,
    samples_from_events,
)
from chunkwise.operators import chunks as C
from chunkwise.operators import tiering as T
from chunkwise.plans.alignment import align_compression
from chunkwise.plans.fixtures import ATTACHMENTS, INDEXES, compression_settings, compression_state
from chunkwise.plans.mover import run_chunk_mover
from chunkwise.sources.readers import jdbc_options, read_samples, read_table

from conftest import SF_SMALL


def test_chunk_mover_end_to_end(spark):
    s = load_samples(spark, SF_SMALL)
    hot, cold = work_dir(spark, "hot"), work_dir(spark, "cold")
    T.store_samples(s, hot)
    run = run_chunk_mover(spark, hot, cold, ["click", "error", "signup"], attachments_df(spark, ATTACHMENTS), indexes_df(spark, INDEXES))
    plan = run.plan.collect()
    assert {r.hypertable_name for r in plan} == {"click", "error", "signup"}
    assert all(r.range_start < Params().cutoff for r in plan)
    st = run.status.collect()
    assert len(st) == len(plan) and all(r.ok for r in st)


def test_alignment_flow(spark, tmp_dir):
    s = load_samples(spark, SF_SMALL)
    ht = C.hypertable_catalog(C.chunk_inventory(s))
    out = align_compression(compression_state(ht, "left"), compression_state(ht, "right"), compression_settings(ht),
                            "prom_data", s, tmp_dir)
    names = {r.hypertable_name for r in out.rules.collect()}
    assert out.layout.count() == s.filter(F.col("metric").isin(list(names))).count()
    assert out.drift.count() >= len(names)


def test_read_samples_parquet(spark):
    df = read_samples(spark, {"path": f"{SF_SMALL}/events.parquet", "where": "user_id > 3"}, samples_from_events)
    assert df.filter(F.col("user_id") <= 3).count() == 0 and df.count() > 0
    cols = read_table(spark, {"path": f"{SF_SMALL}/events.parquet", "columns": ["ts"]}).columns
    assert cols == ["ts"]


def test_jdbc_spec_validation(spark):
    spec = jdbc_options("jdbc:postgresql://db/x", "prom_data.m", partition_column="id", lower=0, upper=10, partitions=4)
    assert spec["numPartitions"] == 4 and spec["fetchsize"] == 10000
    with pytest.raises(ValueError):
        read_table(spark, {"format": "jdbc", "url": "jdbc:x", "dbtable": "t", "partitionColumn": "id"})


def test_cli_inventory(spark, tmp_dir):
    from chunkwise.__main__ import main

    main(["inventory", "--samples", f"{SF_SMALL}/events.parquet", "--events", "--out", tmp_dir])
    got = spark.read.parquet(tmp_dir)
    assert got.count() == C.chunk_inventory(load_samples(spark, SF_SMALL)).count()


def test_cli_writes_whole_reports(spark, tmp_dir):
    from chunkwise.__main__ import main

    events = ["--samples", f"{SF_SMALL}/events.parquet", "--events", "--as-of", "2024-01-31T00:00:00"]
    for command, columns in (("distribution", "highest_loaded_dn"), ("sizes", "size_pretty"), ("old-chunks", "chunk_full_name"), ("largest-old", "total_bytes")):
        main([command, *events, "--out", f"{tmp_dir}/{command}"])
        assert columns in spark.read.parquet(f"{tmp_dir}/{command}").columns
    main(["placement", *events, "--block", '[[0, "dn1"]]', "--allow", "[]", "--out", f"{tmp_dir}/p"])
    assert spark.read.parquet(f"{tmp_dir}/p/block").count() == 5


def test_cli_migrates_per_metric_tables(spark, tmp_dir):
    from chunkwise.__main__ import main

    s = load_samples(spark, SF_SMALL)
    for m in ("click", "view"):
        s.filter(F.col("metric") == m).drop("metric").write.parquet(f"{tmp_dir}/{m}")
    spark.createDataFrame([], "labels string, series_id long").write.parquet(f"{tmp_dir}/target")
    for m in ("click", "view"):
        main(["migrate-sql", "--table", f"{m}={tmp_dir}/{m}", "--metric", m, "--target-series", f"{tmp_dir}/target", "--out", f"{tmp_dir}/out_{m}"])
        assert spark.read.parquet(f"{tmp_dir}/out_{m}/status").first().state == "ok"
    ids = [r.series_id for r in spark.read.parquet(f"{tmp_dir}/target").collect()]
    assert len(ids) == len(set(ids)) == s.filter(F.col("metric").isin("click", "view")).select("labels").distinct().count()
    main(["migrate-jsonl", "--table", f"click={tmp_dir}/click", "--metric", "click", "--transport", "chunkwise.sources.sinks:StubTransport", "--out", f"{tmp_dir}/j"])
    assert spark.read.parquet(f"{tmp_dir}/j/status").first().n_rejected == 0


def test_cluster_conf_sizes_partitions():
    from chunkwise.session import cluster_conf

    conf = cluster_conf(100 * 10**12, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (256 << 20))
    assert int(cluster_conf(10**6, 64)["spark.sql.shuffle.partitions"]) == 128
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true" and "spark.ui.enabled" not in conf


def test_work_dir_under_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a.startswith(base) and b.startswith(base) and a != b


def test_cli_rejects_non_samples_table(spark):
    from chunkwise.__main__ import main

    with pytest.raises(ValueError, match="missing columns"):
        main(["sizes", "--samples", f"{SF_SMALL}/events.parquet", "--out", "unused"])

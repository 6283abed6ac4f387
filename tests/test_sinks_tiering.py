import datetime as dt
import os

from pyspark.sql import functions as F

from chunkwise.config import materialize, work_dir
from chunkwise.model import attachments_df, indexes_df, load_samples, series_dictionary
from chunkwise.operators import chunks as C
from chunkwise.operators import tiering as T
from chunkwise.plans import migrate as W
from chunkwise.plans.fixtures import ATTACHMENTS, INDEXES, target_series
from chunkwise.sources.sinks import StubTransport
from chunkwise.sources.readers import metric_filter, metrics_dictionary, read_nodes, read_table, snapshot_series

from conftest import SF_SMALL
from helpers import SAMPLE_SCHEMA

CUT = dt.datetime(2024, 1, 21)


_fail_error_metric = StubTransport(failing_metrics=["error"])


def test_migrate_jsonl_status_and_rerun(spark):
    s = load_samples(spark, SF_SMALL)
    series = series_dictionary(s)
    path = work_dir(spark, "jsonl")
    run = W.migrate_jsonl(s, series, ["click", "error", "nosuch"], 4, path, _fail_error_metric, lines_per_request=7)
    st = {r.metric: r for r in run.status.collect()}
    assert st["nosuch"].rows_in == 0 and st["nosuch"].n_lines == 0
    assert st["error"].n_rejected == st["error"].n_lines > 0
    assert st["click"].n_rejected == 0
    assert run.push_status.filter(F.col("n_lines") > 7).count() == 0
    first = sorted(r.value for r in spark.read.text(path).collect())
    # a rerun overwrites per metric: identical output, no duplicates
    W.migrate_jsonl(s, series, ["click", "error", "nosuch"], 4, path, None)
    assert sorted(r.value for r in spark.read.text(path).collect()) == first
    # every sample appears exactly once over the lines
    n_points = spark.read.text(path).select(F.size(F.from_json("value", "struct<values:array<double>>").values).alias("n"))
    assert n_points.agg(F.sum("n")).first()[0] == s.filter(F.col("metric").isin("click", "error")).count()


def test_migrate_sql_files_and_status(spark):
    s = load_samples(spark, SF_SMALL)
    series = series_dictionary(s)
    path = work_dir(spark, "sql")
    run = W.migrate_sql(s, series, target_series(series), ["click", "nosuch"], 50, "prom_data", path)
    st = {r.metric: r for r in run.status.collect()}
    assert st["click"].rows_in == st["click"].rows_out > 0
    assert st["nosuch"].rows_in == 0
    assert os.path.isdir(os.path.join(path, "metric=click"))
    stmts = [r.value for r in spark.read.text(path).collect()]
    assert all(x.startswith('INSERT INTO prom_data."click" values (TIMESTAMPTZ ') and x.endswith(");") for x in stmts)
    assert sum(x.count("(TIMESTAMPTZ ") for x in stmts) == st["click"].rows_in


def test_missing_labels_counted(spark):
    s = load_samples(spark, SF_SMALL)
    series = series_dictionary(s).filter(F.get_json_object("labels", "$.user").cast("long") % 2 == 0)
    # read back from what was written: nothing is said about rows that aren't there
    run = W.migrate_sql(s, series, target_series(series), ["click"], 50, "prom_data")
    r = run.status.first()
    assert r.n_missing_labels > 0 and r.rows_out == r.rows_in - r.n_missing_labels


def test_metric_filter_unknown_names(spark):
    s = load_samples(spark, SF_SMALL)
    sel, status = metric_filter(s, metrics_dictionary(s), ["click", "nosuch"])
    got = {r.metric: r for r in status.collect()}
    assert got["nosuch"].metric_id is None and got["nosuch"].n_samples == 0
    assert got["click"].n_samples == sel.count() > 0


def test_snapshot_create_once(spark):
    s = load_samples(spark, SF_SMALL)
    series = series_dictionary(s)
    path = work_dir(spark, "snap")
    a = snapshot_series(spark, series, path, ["click"])
    n = a.count()
    b = snapshot_series(spark, series, path, ["click", "view"])
    assert b.filter(F.col("metric") == "click").count() == n
    assert b.filter(F.col("metric") == "view").count() > 0


def test_read_nodes_union(spark):
    path = os.path.join(SF_SMALL, "events.parquet")
    specs = {f"dn{k + 1}": {"path": path, "where": f"user_id % 4 = {k}"} for k in range(4)}
    u = read_nodes(spark, specs)
    assert u.count() == read_table(spark, {"path": path}).count()
    assert {r.node for r in u.select("node").distinct().collect()} == {"dn1", "dn2", "dn3", "dn4"}


def test_move_chunks_preserves_rows(spark):
    s = load_samples(spark, SF_SMALL)
    ch = C.chunk_inventory(s)
    ht = C.hypertable_catalog(ch)
    plan = T.move_plan(
        C.chunk_inventory(s, older_than=CUT), ht, indexes_df(spark, INDEXES), attachments_df(spark, ATTACHMENTS),
        ["click", "error", "signup"], "prom_data", "cold_space", "cold_space",
    )
    hot, cold = work_dir(spark, "hot"), work_dir(spark, "cold")
    T.store_samples(s, hot)
    status = T.move_chunks(spark, hot, cold, plan).collect()
    assert status and all(r.ok for r in status)
    cols = ["metric", "series_id", "ts", "user_id", "node"]
    moved = sorted(map(tuple, T.read_chunks(spark, cold, plan).select(*cols).collect()))
    expect = sorted(map(tuple, T.read_chunks(spark, hot, plan).select(*cols).collect()))
    assert moved == expect and len(moved) == sum(r.rows_hot for r in status)
    # idempotent rerun
    assert all(r.ok for r in T.move_chunks(spark, hot, cold, plan).collect())
    # the click chunk is sorted by its reorder index (series_id, ts) inside each file
    files = spark.read.parquet(cold).filter(F.col("metric") == "click").select(F.col("_metadata.file_path").alias("f"))
    for f in [r.f for r in files.distinct().collect()]:
        part = [(r.series_id, r.ts) for r in spark.read.parquet(f).collect()]
        assert part == sorted(part)


def test_chunk_files(spark):
    s = load_samples(spark, SF_SMALL)
    path = work_dir(spark, "stored")
    T.store_samples(s, path)
    files = T.chunk_files(spark, path)
    assert files.count() == C.chunk_inventory(s).count()
    assert files.filter(F.col("file_bytes") <= 0).count() == 0


def test_push_needs_no_package_on_workers(tmp_path):
    """The stub transport is pickled by value: a process without the package
    on its path can load and call it."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    blob = tmp_path / "t.pkl"
    blob.write_bytes(cloudpickle.dumps(StubTransport(failing_metrics=["x"])))
    code = "import pickle,sys; t=pickle.load(open(sys.argv[1],'rb')); print(t('x', []), t('y', []))"
    out = subprocess.run([sys.executable, "-c", code, str(blob)], cwd=str(tmp_path), capture_output=True, text=True,
                         env={"PATH": "/usr/bin:/bin"}, timeout=120)
    assert out.stdout.split() == ["500", "204"], out.stderr[-500:]


def test_migrate_jsonl_raises_on_reject(spark):
    import pytest

    s = load_samples(spark, SF_SMALL)
    with pytest.raises(RuntimeError, match="error"):
        W.migrate_jsonl(s, series_dictionary(s), ["click", "error"], 4, work_dir(spark, "j"), _fail_error_metric,
                        raise_on_reject=True)


def test_only_listed_metrics_are_pushed_and_stale_lines_go(spark):
    s = load_samples(spark, SF_SMALL)
    series = series_dictionary(s)
    path = work_dir(spark, "jsonl")
    W.migrate_jsonl(s, series, ["click"], 4, path, StubTransport())
    second = W.migrate_jsonl(s, series, ["view"], 4, path, StubTransport())
    assert {r.metric for r in second.push_status.collect()} == {"view"}
    rerun = W.migrate_jsonl(s.filter("metric <> 'click'"), series, ["click", "nosuch"], 4, path)
    got = {r.metric: (r.rows_in, r.rows_out, r.n_lines, r.state) for r in rerun.status.collect()}
    assert got == {"click": (0, 0, 0, "ok"), "nosuch": (0, 0, 0, "ok")}
    only = W.migrate_jsonl(s, series, ["nosuch"], 4, work_dir(spark, "none"))
    assert only.status.first().rows_in == 0


def test_a_metric_with_bad_labels_fails_alone(spark):
    rows = [("good", 1, '{"a":"1"}'), ("bad", 2, "not json"), ("bad", 3, '{"a":"3"}')]
    s = spark.createDataFrame([(m, i, l, 1.0) for m, i, l in rows for _ in range(3)], "metric string, series_id long, labels string, value double")
    s = s.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    target = spark.createDataFrame([('{"a":"1"}', 9), ('{"a":"1"}', 7)], "labels string, series_id long")
    for run in (
        W.migrate_sql(s, series_dictionary(s), target, ["good", "bad"], 5, "p", work_dir(spark, "sql")),
        W.migrate_jsonl(s, series_dictionary(s), ["good", "bad"], 5, work_dir(spark, "lines")),
    ):
        got = {r.metric: (r.rows_in, r.rows_out, r.n_bad_labels, r.state) for r in run.status.collect()}
        assert got == {"good": (3, 3, 0, "ok"), "bad": (6, 0, 1, "failed")}
    ids = W.migrate_sql(s, series_dictionary(s), target, ["good", "bad"], 5, "p")
    assert [r.labels for r in ids.rejected.collect()] == ["not json"]
    assert {r.series_id for r in ids.mapping.collect()} == {7}  # a label set held twice keeps its smallest id


def test_snapshot_of_unknown_metric_is_empty_and_drops(spark):
    from chunkwise.sources.readers import drop_snapshot

    s = load_samples(spark, SF_SMALL)
    path = work_dir(spark, "snap2")
    assert snapshot_series(spark, series_dictionary(s), path, ["nosuch"]).count() == 0
    assert snapshot_series(spark, series_dictionary(s), path, ["click", "view"]).count() > 0
    drop_snapshot(spark, path, ["click"])
    assert {r.metric for r in spark.read.parquet(path).select("metric").distinct().collect()} == {"view"}
    drop_snapshot(spark, path)
    assert not os.path.exists(path)


def test_move_of_many_planned_chunks(spark):
    """More planned chunks than any cap of earlier versions, of a width of six hours."""
    n = 10_001
    rows = spark.range(n).select(
        F.concat(F.lit("m"), F.col("id")).alias("metric"), F.lit("dn1").alias("node"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 7 * 21600).cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("series_id"), F.lit(1.5).alias("value"),
    )
    plan = rows.select(
        F.col("metric").alias("hypertable_name"), F.col("node").alias("node_name"), F.col("ts").alias("range_start"),
        (F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("range_end"), F.lit(1).cast("long").alias("n_rows"),
        F.array(F.lit("ts")).alias("reorder_columns"),
    )
    from chunkwise.config import materialize

    plan = materialize(plan, "plan")
    hot, cold = work_dir(spark, "many_hot"), work_dir(spark, "many_cold")
    rows.withColumn("chunk", F.lit("all")).write.parquet(hot)  # any folders serve: chunks are found by time
    import chunkwise.operators.tiering as tiering

    tally = tiering.planned_rows(spark.read.parquet(hot), tiering.touched_chunks(tiering.stored_chunks(spark, hot), plan))
    assert tally.count() == n and tally.select("metric", "chunk").distinct().count() == n
    few = plan.where("hypertable_name IN ('m1', 'm2', 'm9999')")
    status = T.move_chunks(spark, hot, cold, few).collect()
    assert len(status) == 3 and all(r.ok and r.rows_plan == r.rows_hot == r.rows_cold == 1 for r in status)


def test_incomplete_move_is_not_ok(spark):
    s = load_samples(spark, SF_SMALL)
    hot, cold = work_dir(spark, "hot_part"), work_dir(spark, "cold_part")
    T.store_samples(s, hot, every="7 days")
    from chunkwise.config import Params
    from chunkwise.plans.mover import plan_moves

    plan = plan_moves(s, ["click"], attachments_df(spark, ATTACHMENTS), indexes_df(spark, INDEXES), Params(every="7 days"))
    short = plan.withColumn("n_rows", F.col("n_rows") + 1)
    assert [r.ok for r in T.move_chunks(spark, hot, cold, short).collect()] == [False]
    assert [r.ok for r in T.move_chunks(spark, hot, cold, plan).collect()] == [True]


def test_two_widths_keep_their_folders(spark, tmp_dir):
    """A week's and a day's chunk that start together share no folder on the cold tier."""
    start = dt.datetime(2024, 1, 4)
    s = spark.createDataFrame([("click", 1, 1, start + dt.timedelta(hours=16 * i), float(i), "dn1", "{}", "p") for i in range(10)], SAMPLE_SCHEMA)
    plans = {}
    for days in (7, 1):
        hot = f"{tmp_dir}/hot{days}"
        T.store_samples(s, hot, every=f"{days} days")
        n = s.where(F.col("ts") < F.lit(start + dt.timedelta(days=days))).count()
        row = ("prom_data", "click", "dn1", start, start + dt.timedelta(days=days), n, None)
        plans[days] = spark.createDataFrame([row], "hypertable_schema string, hypertable_name string, node_name string, range_start timestamp_ntz, range_end timestamp_ntz, n_rows long, reorder_columns array<string>")
        assert T.move_chunks(spark, hot, f"{tmp_dir}/cold", plans[days]).first()["ok"]
    assert T.read_chunks(spark, f"{tmp_dir}/cold", plans[7]).count() == 10 and T.read_chunks(spark, f"{tmp_dir}/cold", plans[1]).count() == 2
    index = T.stored_chunks(spark, f"{tmp_dir}/cold").collect()
    assert sorted((r["range_end"] - r["range_start"]).days for r in index) == [1, 7]


def test_a_move_reads_only_the_folders_it_touches(spark, tmp_dir):
    start = dt.datetime(2024, 1, 1)
    s = spark.createDataFrame([("click", 1, 1, start + dt.timedelta(hours=6 * i), float(i), f"dn{i % 2}", "{}", "p") for i in range(80)], SAMPLE_SCHEMA)
    T.store_samples(s, f"{tmp_dir}/hot", every="1 day")
    row = ("prom_data", "click", "dn1", start + dt.timedelta(days=3), start + dt.timedelta(days=5), 4, None)
    plan = spark.createDataFrame([row], "hypertable_schema string, hypertable_name string, node_name string, range_start timestamp_ntz, range_end timestamp_ntz, n_rows long, reorder_columns array<string>")
    touched = T.touched_chunks(T.stored_chunks(spark, f"{tmp_dir}/hot"), plan)
    assert sorted(r["chunk"] for r in touched.collect()) == ["c20240104T000000_20240105T000000", "c20240105T000000_20240106T000000"]
    rows = T.planned_rows(spark.read.parquet(f"{tmp_dir}/hot"), materialize(touched, "touched"))
    assert rows.count() == 4
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString().lower()


def test_first_run_against_an_empty_target(spark, tmp_dir):
    s = load_samples(spark, SF_SMALL)
    series = series_dictionary(s)
    for target in (f"{tmp_dir}/target", None):
        run = W.migrate_sql(s, series, target, ["click"], 50, "prom_data")
        ids = [r["series_id"] for r in run.new_target.collect()]
        assert sorted(ids) == list(range(1, len(ids) + 1)) and run.status.first()["state"] == "ok"
    again = W.migrate_sql(s, series, f"{tmp_dir}/target", ["click"], 50, "prom_data")
    assert not again.mapping.filter("created").head(1)

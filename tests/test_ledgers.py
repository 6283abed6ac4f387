"""Runs that fail in part, are run again, or run at the same time."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from chunkwise.model import load_samples, series_dictionary
from chunkwise.plans import migrate as W
from chunkwise.sources import target_store as S
from chunkwise.sources.ledger import METRIC_LEDGER, finished_metrics, push_pending, read_ledger
from chunkwise.sources.sinks import StubTransport, read_text

from conftest import SF_SMALL

METRICS = ["click", "view", "error", "nosuch"]


def _broken(samples, metric):
    bad = F.when(F.col("metric") == metric, F.raise_error(F.lit("unreadable")).cast("double"))
    return samples.withColumn("value", bad.otherwise(F.col("value")))


def _files(path):
    return {f: os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if "metric=" in d}


@pytest.mark.parametrize("flow", ["sql", "jsonl"])
def test_a_metric_that_fails_is_alone_and_is_resumed(spark, tmp_dir, flow):
    s = load_samples(spark, SF_SMALL)
    series = series_dictionary(s)

    def run(samples, resume=False):
        if flow == "sql":
            return W.migrate_sql(samples, series, f"{tmp_dir}/target", METRICS, 50, "p", f"{tmp_dir}/out", resume=resume)
        return W.migrate_jsonl(samples, series, METRICS, 50, f"{tmp_dir}/out", resume=resume)

    first = run(_broken(s, "view"))
    assert {r.metric: r.state for r in first.status.collect()} == {"click": "ok", "view": "failed", "error": "ok", "nosuch": "ok"}
    assert list(first.errors) == ["view"]
    assert finished_metrics(spark, f"{tmp_dir}/out/_ledger") == {"click", "error", "nosuch"}
    before = _files(f"{tmp_dir}/out")
    assert before and not os.path.exists(f"{tmp_dir}/out/metric=view")
    again = run(s, resume=True)
    got = {r.metric: (r.state, r.rows_in - r.rows_out) for r in again.status.collect()}
    assert got == {m: ("ok", 0) for m in METRICS} and not again.errors
    after = _files(f"{tmp_dir}/out")
    assert {f: t for f, t in after.items() if f in before} == before and len(after) > len(before)
    entries = read_ledger(spark, f"{tmp_dir}/out/_ledger", METRIC_LEDGER).groupBy("metric").count().collect()
    assert {r["metric"]: r["count"] for r in entries} == {"click": 1, "view": 2, "error": 1, "nosuch": 1}
    # the whole equals one run without a failure
    whole = f"{tmp_dir}/whole"
    if flow == "sql":
        W.migrate_sql(s, series, f"{tmp_dir}/target", METRICS, 50, "p", whole)
    else:
        W.migrate_jsonl(s, series, METRICS, 50, whole)
    assert sorted(map(tuple, read_text(spark, whole).collect())) == sorted(map(tuple, read_text(spark, f"{tmp_dir}/out").collect()))


def test_second_push_sends_refused_lines_only(spark, tmp_dir):
    lines = spark.createDataFrame([("a", f"line {i}") for i in range(20)] + [("b", "x"), ("b", "x"), ("b", "")], "metric string, line string")
    ledger = f"{tmp_dir}/push"
    first = push_pending(lines, StubTransport(failing_metrics=["b"]), ledger, 6)
    assert first.agg(F.sum("n_lines")).first()[0] == 23
    second = push_pending(lines, StubTransport(failing_metrics=["b"]), ledger, 6)
    assert {r["metric"] for r in second.collect()} == {"b"} and second.agg(F.sum("n_lines")).first()[0] == 3
    third = push_pending(lines, StubTransport(), ledger, 6)
    assert third.agg(F.sum("n_lines")).first()[0] == 3
    assert push_pending(lines, StubTransport(), ledger, 6).collect() == []
    # a line that came later goes, and so does the same text of another metric
    more = lines.unionByName(spark.createDataFrame([("a", "late"), ("b", "line 1")], lines.schema))
    sent = push_pending(more, StubTransport(), ledger, 6)
    assert sorted((r["metric"], r["n_lines"]) for r in sent.collect()) == [("a", 1), ("b", 1)]


def _labels(spark, names):
    return spark.createDataFrame([(f'{{"n":"{n}"}}',) for n in names], "labels string")


def test_the_loser_of_a_version_tries_again(spark, tmp_dir, monkeypatch):
    """A rival commits between this run's read and its commit, twice."""
    path = f"{tmp_dir}/target"
    _labels(spark, ["old"]).withColumn("series_id", F.lit(41).cast("long")).write.parquet(path)
    claim, rivals = S._claim, [["r1", "shared"], ["r2"]]

    def claim_after_rival(*args):
        if rivals:
            names = rivals.pop(0)
            with monkeypatch.context() as m:
                m.setattr(S, "_claim", claim)
                S.allocate_series(spark, _labels(spark, names), path)
        return claim(*args)

    monkeypatch.setattr(S, "_claim", claim_after_rival)
    mapping = S.allocate_series(spark, _labels(spark, ["old", "mine", "shared"]), path)
    stored = {r["labels"]: r["series_id"] for r in S.read_target(spark, path).collect()}
    assert sorted(stored.values()) == [41, 42, 43, 44, 45] and len(stored) == 5
    assert {r["labels"]: r["series_id"] for r in mapping.collect()} == {k: stored[k] for k in ('{"n":"old"}', '{"n":"mine"}', '{"n":"shared"}')}
    assert len(S.target_versions(spark, path)) == 3
    assert not [f for f in os.listdir(path) if f.startswith("_aside")]


def test_runs_at_once_give_no_id_twice(spark, tmp_dir):
    path = f"{tmp_dir}/target"
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda k: S.allocate_series(spark, _labels(spark, [f"s{i}" for i in range(k, k + 6)]), path), (0, 3, 6)))
    stored = S.read_target(spark, path).collect()
    assert sorted(r["series_id"] for r in stored) == list(range(1, 13)) and len({r["labels"] for r in stored}) == 12


def test_the_target_is_also_a_plain_table(spark, tmp_dir):
    path = f"{tmp_dir}/target"
    for names in (["a", "b"], ["b", "c"]):
        S.allocate_series(spark, _labels(spark, names), path)
    stored = sorted(map(tuple, S.read_target(spark, path).collect()))
    assert sorted(map(tuple, spark.read.parquet(path).select("labels", "series_id").collect())) == stored and len(stored) == 3

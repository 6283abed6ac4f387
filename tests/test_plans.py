"""Plan checks: the physical plans have the shape the design promises."""

import datetime as dt

from chunkwise.model import load_samples, series_dictionary
from chunkwise.operators import chunks as C
from chunkwise.operators import series as J
from chunkwise.plans import REGISTRY

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_registered_queries(spark):
    for name, q in REGISTRY.items():
        if name in ("push_status", "migrate_status", "migration_status", "series_snapshot") or name.startswith("moved_rows"):
            continue  # these write or push; their results are read back
        p = _plan(q.build(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_column_pruning_on_inventory(spark):
    p = _plan(C.chunk_inventory(load_samples(spark, SF_SMALL)))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in p


def test_age_filter_reaches_scan(spark):
    p = _plan(C.chunk_inventory(load_samples(spark, SF_SMALL), newer_than=dt.datetime(2024, 1, 21)))
    assert "GreaterThanOrEqual(ts,2024-01-21T00:00)" in p


def test_partial_aggregation(spark):
    p = _plan(C.chunk_inventory(load_samples(spark, SF_SMALL)))
    assert p.count("HashAggregate") >= 2


def test_labels_join_is_equi_join(spark):
    s = load_samples(spark, SF_SMALL)
    df = J.samples_with_labels(s, series_dictionary(s))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in final and "NestedLoop" not in final
    # the small dictionary is broadcast from its measured size (adaptive execution)
    assert "BroadcastHashJoin" in final


def test_reports_read_the_samples_once(spark, monkeypatch):
    """Each chunk, size, placement and policy query scans the events table once: in the
    table that it writes first, or in its own plan."""
    from pyspark.sql import DataFrameReader

    reads = []
    real = DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *p, **o: (reads.append(p[0]), real(self, *p, **o))[1])
    names = [
        "chunks_lateral", "chunks_older_all", "old_chunks_sized", "node_hypertables", "node_distribution", "block_plan",
        "effective_placement", "policy_drift", "compression_rules", "compression_ddl", "move_plan", "metric_filter",
    ]
    for name in names:
        reads.clear()
        p = _plan(REGISTRY[name].build(spark, SF_SMALL))
        assert sum("events" in r for r in reads) == 1, name
        if any("chunkwise" in r for r in reads):  # what was written is read from then on
            assert "event_type" not in p, name
        else:
            assert p.count("event_type:string") <= 1, name


def test_many_rules_take_one_scan(spark):
    from pyspark.sql import functions as F

    from chunkwise.operators.layout import masked_sort_keys

    columns = ["series_id", "ts", "value", "node", "user_id"]
    terms = [(f"m{i}", [(columns[(i + k) % 5], (i >> k) % 2 == 0, (i >> (k + 2)) % 2 == 0) for k in range(1 + i % 3)]) for i in range(50)]
    own = spark.createDataFrame(terms, "metric string, _order array<struct<column:string,asc:boolean,nulls_first:boolean>>")
    rows = load_samples(spark, SF_SMALL)
    keys = masked_sort_keys(own.select("_order"), F.col("_order"), rows.columns)
    p = _plan(rows.join(own, "metric").sortWithinPartitions("metric", *keys))
    assert p.count("FileScan parquet") == 1

from pyspark.sql import functions as F

from chunkwise.operators import compression as G
from helpers import samples_df

SETTINGS = "hypertable_schema string, hypertable_name string, attname string, segmentby_column_index int, " \
    "orderby_column_index int, orderby_asc boolean, orderby_nullsfirst boolean"


def _settings(spark):
    rows = [
        ("s", "t", "a", None, 1, True, False),
        ("s", "t", "b", None, 2, True, True),
        ("s", "t", "c", None, 3, False, True),
        ("s", "t", "d", None, 4, False, False),
        ("s", "t", "seg2", 2, None, None, None),
        ("s", "t", "seg1", 1, None, None, None),
        ("s", "t", "plain", None, None, None, None),
        ("other", "t", "x", 1, 1, True, False),
    ]
    return spark.createDataFrame(rows, SETTINGS)


def test_orderby_four_combinations(spark):
    got = {(r.hypertable_schema, r.hypertable_name): r.orderby for r in G.orderby_rules(_settings(spark)).collect()}
    assert got[("s", "t")] == ["a", "b NULLS FIRST", "c DESC", "d DESC NULLS LAST"]
    assert got[("other", "t")] == ["x"]


def test_segmentby_in_index_order(spark):
    got = {(r.hypertable_schema, r.hypertable_name): r.segmentby for r in G.segmentby_rules(_settings(spark)).collect()}
    assert got[("s", "t")] == ["seg1", "seg2"]


def test_rules_empty_for_table_without_settings(spark):
    tables = spark.createDataFrame([("s", "t"), ("s", "bare")], "hypertable_schema string, hypertable_name string")
    got = {r.hypertable_name: (r.orderby, r.segmentby) for r in G.compression_rules(tables, _settings(spark)).collect()}
    assert got["bare"] == ([], [])
    assert got["t"][1] == ["seg1", "seg2"]


def test_compressed_tables_truthy_state(spark):
    st = spark.createDataFrame(
        [("prom_data", "a", 1), ("prom_data", "b", 0), ("prom_data", "c", 2), ("x", "d", 1)],
        "hypertable_schema string, hypertable_name string, compression_state int",
    )
    assert sorted(r.hypertable_name for r in G.compressed_tables(st, "prom_data").collect()) == ["a", "c"]
    assert [r.hypertable_name for r in G.compressed_tables(st, "prom_data", limit=1).collect()] == ["a"]


def test_policy_drift_statuses(spark):
    schema = "hypertable_schema string, hypertable_name string, compression_state int"
    left = spark.createDataFrame([("s", "same", 1), ("s", "diff", 1), ("s", "only_left", 1)], schema)
    right = spark.createDataFrame([("s", "same", 1), ("s", "diff", 0), ("s", "only_right", 0)], schema)
    got = {r.hypertable_name: r.status for r in G.policy_drift(left, right).collect()}
    assert got == {"same": "same", "diff": "differs", "only_left": "missing_right", "only_right": "missing_left"}


def test_apply_layout_keeps_rows_and_sorts(spark, tmp_dir):
    s = samples_df(spark, [("m1", "dn1", 1, 0, 30, "x"), ("m1", "dn2", 2, 0, 30, "y"), ("m2", "dn1", 1, 0, 10, "z")])
    rules = spark.createDataFrame(
        [("m1", [("value", False, True)], ["node"]), ("m2", [("ts", True, False)], [])],
        "hypertable_name string, orderby_terms array<struct<column:string,asc:boolean,nulls_first:boolean>>, segmentby array<string>",
    )
    out = G.apply_layout(s, rules, tmp_dir)
    cols = ["metric", "series_id", "ts", "value", "node"]
    assert sorted(map(tuple, out.select(*cols).collect())) == sorted(map(tuple, s.select(*cols).collect()))
    # each written file of m1 is clustered by node and sorted by value descending
    files = out.filter(F.col("metric") == "m1").withColumn("f", F.input_file_name())
    for f in [r.f for r in files.select("f").distinct().collect()]:
        part = [(r.node, -r.value) for r in spark.read.parquet(f).collect()]
        assert part == sorted(part)
    # a rerun replaces the files instead of adding rows
    out2 = G.apply_layout(s, rules, tmp_dir)
    assert out2.count() == s.count()


def test_layout_takes_any_column_name_and_rejects_unknown_ones(spark, tmp_dir):
    import pytest

    s = samples_df(spark, [("m1", "dn1", 1, 0, 5, "x")]).withColumn("my col", F.col("value") * -1)
    schema = "hypertable_name string, orderby_terms array<struct<column:string,asc:boolean,nulls_first:boolean>>, segmentby array<string>"
    out = G.apply_layout(s, spark.createDataFrame([("m1", [("my col", True, False)], [])], schema), tmp_dir)
    files = out.select("value", F.input_file_name().alias("f")).collect()
    for f in {r.f for r in files}:
        values = [r.value for r in files if r.f == f]
        assert values == sorted(values, reverse=True)
    assert sorted(r.value for r in files) == [0.0, 1.0, 2.0, 3.0, 4.0]
    with pytest.raises(ValueError, match="no such column"):
        G.apply_layout(s, spark.createDataFrame([("m1", [("nope", True, False)], [])], schema), tmp_dir)


def test_compression_statements(spark):
    tables = spark.createDataFrame([("s", "t"), ("s", "order")], "hypertable_schema string, hypertable_name string")
    got = {r.hypertable_name: r.statement for r in G.compression_ddl(G.compression_rules(tables, _settings(spark))).collect()}
    assert got["order"] == 'ALTER TABLE s."order" SET (timescaledb.compress);'
    assert got["t"] == (
        "ALTER TABLE s.t SET (timescaledb.compress, timescaledb.compress_segmentby = 'seg1, seg2', "
        "timescaledb.compress_orderby = 'a, b NULLS FIRST, c DESC, d DESC NULLS LAST');"
    )

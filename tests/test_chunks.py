import datetime as dt

from pyspark.sql import functions as F

from chunkwise.model import load_samples
from chunkwise.operators import chunks as C
from chunkwise.operators import placement as P
from chunkwise.operators import tiering as T
from helpers import samples_df

from conftest import SF_SMALL

CUT = dt.datetime(2024, 1, 21)


def test_inventory_sums_rows(spark):
    s = load_samples(spark, SF_SMALL)
    ch = C.chunk_inventory(s)
    assert ch.agg(F.sum("n_rows")).first()[0] == s.count()
    r = ch.first()
    assert r.total_bytes == r.table_bytes + r.index_bytes + r.toast_bytes
    assert r.range_end - r.range_start == dt.timedelta(days=1)


def test_chunk_names_and_bytes(spark):
    s = samples_df(spark, [("m", "dn1", 3, 5, 2, "abc"), ("m", "dn1", 3, 7, 1, "é")])
    r = C.chunk_inventory(s).collect()
    assert len(r) == 1
    r = r[0]
    assert r.chunk_name == "_hyper_m_20240103_dn1_chunk"
    assert r.n_rows == 3 and r.table_bytes == 72 and r.index_bytes == 48 and r.toast_bytes == 2 * 3 + 2
    assert r.range_start == dt.datetime(2024, 1, 3)


def test_older_newer_split_and_pushdown(spark):
    s = load_samples(spark, SF_SMALL)
    every = C.chunk_inventory(s).count()
    old = C.chunk_inventory(s, older_than=CUT)
    new = C.chunk_inventory(s, newer_than=CUT)
    assert old.count() + new.count() == every
    assert old.agg(F.max("range_end")).first()[0] <= CUT
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts," in plan


def test_cutoff_inside_a_bucket(spark):
    s = samples_df(spark, [("m", "dn1", 20, 1, 1, "x"), ("m", "dn1", 21, 1, 1, "x"), ("m", "dn1", 22, 1, 1, "x")])
    cut = dt.datetime(2024, 1, 21, 12)
    assert [r.range_start.day for r in C.chunk_inventory(s, older_than=cut).collect()] == [20]
    assert [r.range_start.day for r in C.chunk_inventory(s, newer_than=cut).collect()] == [22]


def test_largest_chunks_keeps_ties_and_one_picks_by_name(spark):
    s = samples_df(spark, [("m", "dn1", 1, 0, 3, "x"), ("m", "dn2", 1, 0, 3, "x"), ("m", "dn1", 2, 0, 1, "x")])
    ch = C.chunk_inventory(s)
    assert C.largest_chunks(ch).count() == 2
    one = C.largest_chunk_one(ch).collect()
    assert len(one) == 1 and one[0].chunk_name == "_hyper_m_20240101_dn1_chunk"


def test_node_distribution_ties_and_nulls(spark):
    ht = spark.createDataFrame(
        [("s", "a", ["dn1", "dn2", "dn3"], 1), ("s", "b", None, 1), ("s", "c", [], 0)],
        "hypertable_schema string, hypertable_name string, data_nodes array<string>, num_chunks long",
    )
    sizes = spark.createDataFrame(
        [("dn1", "s", "a", 100), ("dn2", "s", "a", 100), ("dn1", "s", "b", 5)],
        "data_node string, hypertable_schema string, hypertable_name string, total_bytes long",
    )
    per_node = P.node_hypertables(ht, sizes)
    rows = {(r.data_node, r.hypertable_name): r for r in P.node_distribution(per_node).collect()}
    # null / empty node lists drop (unnest), the unreachable node keeps a null row
    assert set(rows) == {("dn1", "a"), ("dn2", "a"), ("dn3", "a")}
    assert rows[("dn1", "a")].highest_loaded_dn == "dn1"
    assert rows[("dn2", "a")].highest_loaded_dn == "dn2"
    assert rows[("dn3", "a")].total_bytes is None and rows[("dn3", "a")].highest_loaded_dn is None
    assert all(r.max_total_bytes_dn == 100 for r in rows.values())


def test_running_max(spark):
    per_node = spark.createDataFrame(
        [("dn1", "s", "a", 5), ("dn2", "s", "a", 9), ("dn3", "s", "a", 9)],
        "data_node string, hypertable_schema string, hypertable_name string, total_bytes long",
    )
    assert {r.running_max for r in P.running_max(per_node).collect()} == {9}


def test_no_old_chunk_no_move_row(spark):
    s = samples_df(spark, [("recent", "dn1", 25, 0, 2, "x"), ("old", "dn1", 2, 0, 2, "x")])
    ch = C.chunk_inventory(s)
    ht = C.hypertable_catalog(ch)
    att = spark.createDataFrame([("recent", "cold"), ("old", "cold")], "hypertable_name string, tier string")
    idx = spark.createDataFrame([], "schemaname string, tablename string, indexname string, columns array<string>")
    plan = T.move_plan(C.chunk_inventory(s, older_than=CUT), ht, idx, att, ["recent", "old"], "prom_data", "cold", "cold")
    rows = plan.collect()
    assert [r.hypertable_name for r in rows] == ["old"]
    assert rows[0].reorder_index is None


def test_stored_catalog_serves_reports(spark, tmp_dir):
    s = load_samples(spark, SF_SMALL)
    live = C.chunk_inventory(s)
    C.save_catalog(live, tmp_dir)
    stored = C.load_catalog(spark, tmp_dir)
    cols = sorted(live.columns)
    assert sorted(map(tuple, stored.select(*cols).collect())) == sorted(map(tuple, live.select(*cols).collect()))
    a = P.node_distribution(P.node_sizes(stored).drop("num_chunks"), ordered=False)
    b = P.node_distribution(P.node_sizes(live).drop("num_chunks"), ordered=False)
    assert sorted(map(repr, a.select(*sorted(a.columns)).collect())) == sorted(map(repr, b.select(*sorted(b.columns)).collect()))


def test_sub_day_chunks(spark):
    s = samples_df(spark, [("m", "dn1", 3, 1, 2, "x"), ("m", "dn1", 3, 7, 1, "x"), ("m", "dn1", 3, 13, 1, "x")])
    rows = sorted(C.chunk_inventory(s, every="6 hours").collect(), key=lambda r: r.range_start)
    assert [r.chunk_name for r in rows] == [
        "_hyper_m_20240103000000_dn1_chunk", "_hyper_m_20240103060000_dn1_chunk", "_hyper_m_20240103120000_dn1_chunk"
    ]
    assert [r.n_rows for r in rows] == [2, 1, 1]
    assert rows[0].range_end - rows[0].range_start == dt.timedelta(hours=6)

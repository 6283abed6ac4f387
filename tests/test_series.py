from pyspark.sql import Window
from pyspark.sql import functions as F

from chunkwise.model import load_samples, series_dictionary
from chunkwise.operators import batches as B
from chunkwise.operators import series as J
from chunkwise.operators.numbering import hash_ordered_ids, md5_bucket
from chunkwise.plans.fixtures import target_series

from conftest import SF_SMALL
from helpers import samples_df


def test_hash_ids_equal_one_level(spark):
    keys = spark.createDataFrame([(f"k{i}",) for i in range(500)], "k string")
    two = {r.k: r.id for r in hash_ordered_ids(keys, "k", "id", start=10).collect()}
    w = Window.orderBy(md5_bucket(F.col("k")), F.col("k"))
    one = {r.k: r.id for r in keys.select("k", (F.row_number().over(w) + 9).alias("id")).collect()}
    assert two == one


def test_batches_equal_one_level(spark):
    s = load_samples(spark, SF_SMALL)
    two = B.with_batches(s, ["series_id"], ["ts", "value"], 3).select("series_id", "ts", "batch")
    w = Window.partitionBy("series_id").orderBy("ts", "value")
    one = s.select("series_id", "ts", F.floor((F.row_number().over(w) - 1) / 3).cast("long").alias("batch"))
    assert sorted(map(tuple, two.collect())) == sorted(map(tuple, one.collect()))
    sizes = two.groupBy("series_id", "batch").count()
    assert sizes.agg(F.max("count")).first()[0] <= 3


def test_label_order_gives_one_series(spark):
    labels = spark.createDataFrame([('{"b":"2","a":"1"}',), ('{"a":"1","b":"2"}',)], "labels string")
    target = spark.createDataFrame([], "labels string, series_id long")
    mapping, _ = J.get_or_create_series(labels, target)
    rows = mapping.collect()
    assert len(rows) == 1 and rows[0].series_id == 1 and rows[0].created


def test_get_or_create_keeps_existing_and_creates_above_max(spark):
    s = load_samples(spark, SF_SMALL)
    series = series_dictionary(s)
    target = target_series(series)
    existing = {r.labels: r.series_id for r in target.collect()}
    mapping, new_target = J.get_or_create_series(series.select("labels"), target)
    rows = mapping.collect()
    assert len(rows) == series.count()
    ids = [r.series_id for r in rows]
    assert len(set(ids)) == len(ids)
    top = max(existing.values())
    for r in rows:
        if r.labels in existing:
            assert not r.created and r.series_id == existing[r.labels]
        else:
            assert r.created and r.series_id > top
    created = sorted(r.series_id for r in rows if r.created)
    assert created == list(range(top + 1, top + 1 + len(created)))
    # second run against the grown target creates nothing
    again, _ = J.get_or_create_series(series.select("labels"), new_target)
    assert again.filter("created").count() == 0
    assert {r.labels: r.series_id for r in again.collect()} == {r.labels: r.series_id for r in rows}


def test_samples_without_labels_drop(spark):
    s = load_samples(spark, SF_SMALL)
    series = series_dictionary(s)
    some = series.filter(F.col("metric") != "click")
    joined = J.samples_with_labels(s, some)
    assert joined.count() == s.filter(F.col("metric") != "click").count()


def test_remap_samples(spark):
    s = load_samples(spark, SF_SMALL)
    series = series_dictionary(s)
    mapping, _ = J.get_or_create_series(series.select("labels"), target_series(series))
    out = J.remap_samples(s, series, mapping)
    assert out.count() == s.count()
    assert out.select("series_id", "new_series_id").distinct().count() == series.count()


def test_json_lines_nan_and_ms(spark):
    rows = [(1, "2024-01-01 00:00:00.0015", float("nan")), (1, "2024-01-01 00:00:01", 2.5), (1, "2024-01-01 00:00:02", None)]
    s = spark.createDataFrame(rows, "series_id long, t string, value double").select(
        "series_id", F.col("t").cast("timestamp_ntz").alias("ts"), "value"
    )
    series = spark.createDataFrame([(1, "m", '{"__name__":"m","a":"it\'s"}')], "series_id long, metric string, labels string")
    line = B.json_lines(B.batch_records(s, series, 10)).first().line
    assert line == '{"metric":{"__name__":"m","a":"it\'s"},"values":[null,2.5,null],"timestamps":[1704067200001,1704067201000,1704067202000]}'


def test_insert_statement_text(spark):
    rows = [("m'x", "2024-01-01 00:00:00.5", 1.5, 7), ("m'x", "2024-01-01 00:00:01", float("nan"), 7)]
    r = spark.createDataFrame(rows, "metric string, t string, value double, new_series_id long").select(
        "metric", F.col("t").cast("timestamp_ntz").alias("ts"), "value", "new_series_id"
    )
    st = B.insert_statements(r, 150000, "prom_data").collect()
    assert len(st) == 1
    assert st[0].statement == (
        "INSERT INTO prom_data.\"m'x\" values (TIMESTAMPTZ '2024-01-01 00:00:00.5+00', '1.5', '7'), "
        "(TIMESTAMPTZ '2024-01-01 00:00:01+00', 'NaN', '7');"
    )


def test_batch_plan(spark):
    s = load_samples(spark, SF_SMALL)
    got = {r.metric: (r.n_rows, r.n_batches) for r in B.batch_plan(s, 7).collect()}
    for n, k in got.values():
        assert k == -(-n // 7)


def test_batches_keep_rows_without_time(spark):
    rows = [(1, None, 1.0), (1, "2024-01-01 00:00:00", 2.0), (1, "2024-01-01 03:00:00", 3.0), (2, None, 4.0)]
    s = spark.createDataFrame(rows, "series_id long, t string, value double").select(
        "series_id", F.col("t").cast("timestamp_ntz").alias("ts"), "value"
    )
    got = sorted((r.series_id, r.value, r.batch) for r in B.with_batches(s, ["series_id"], ["ts", "value"], 2).collect())
    assert got == [(1, 1.0, 0), (1, 2.0, 0), (1, 3.0, 1), (2, 4.0, 0)]


def test_batches_keep_null_keys_and_need_no_time_first(spark):
    rows = [(None, 3), (None, 1), (1, 2), (1, 5), (1, 4)]
    got = B.with_batches(spark.createDataFrame(rows, "k long, v int"), ["k"], ["v"], 2)
    assert sorted(((r.k or 0), r.v, r.batch) for r in got.collect()) == [(0, 1, 0), (0, 3, 0), (1, 2, 0), (1, 4, 0), (1, 5, 1)]


def test_dictionary_has_one_row_per_id(spark):
    from chunkwise.model import label_conflicts

    rows = [(1, "m", '{"a":"1","b":"2"}'), (1, "m", '{"b":"2","a":"1"}'), (2, "m", '{"a":"2"}'), (2, "m", '{"a":"3"}'), (3, "m", "broken")]
    s = spark.createDataFrame(rows, "series_id long, metric string, labels string")
    got = {r.series_id: r.labels for r in series_dictionary(s).collect()}
    assert got == {1: '{"a":"1","b":"2"}', 2: '{"a":"2"}', 3: "broken"}
    assert [tuple(r) for r in label_conflicts(s).collect()] == [(2, 2)]
    assert J.samples_with_labels(s.select("series_id", "metric"), s).count() == len(rows)


def test_samples_are_collapsed_before_their_labels_are_parsed(spark):
    s = samples_df(spark, [("m", "dn1", 1, 0, 3, "x")]).unionAll(samples_df(spark, [("m", "dn1", 1, 1, 3, "y")]))
    series = series_dictionary(s)
    plan = series._jdf.queryExecution().optimizedPlan().toString()
    # one grouping of the samples by what they hold, and one of its rows
    assert plan.count("Aggregate [") == 2, plan
    assert "from_json" not in plan.split("Aggregate [")[2].lower() and "JsonToStructs" not in plan.split("Aggregate [")[2]
    assert sorted(r["series_id"] for r in series.collect()) == [1000, 1001, 1002]

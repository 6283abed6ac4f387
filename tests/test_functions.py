import datetime as dt

import pytest
from pyspark.sql import functions as F

from chunkwise.functions import (
    canonical_labels,
    ceil_bucket,
    epoch_ms,
    floor_bucket,
    nan_to_null,
    qualified_name,
    size_pretty,
    sql_quote,
)


def test_size_pretty_edges(spark):
    vals = [0, 8192, 10239, 10240, 10485247, 10485248, 16777216, 123456789012, -10240, 5 * 2**40, 3 * 2**50, 1]
    df = spark.createDataFrame([(v,) for v in vals], "b long")
    got = {r.b: r.p for r in df.select("b", size_pretty("b").alias("p")).collect()}
    assert got[0] == "0 bytes"
    assert got[8192] == "8192 bytes"
    assert got[10239] == "10239 bytes"
    assert got[10240] == "10 kB"
    assert got[10485247] == "10239 kB"
    assert got[10485248] == "10 MB"
    assert got[16777216] == "16 MB"
    assert got[123456789012] == "115 GB"
    assert got[-10240] == "-10 kB"
    assert got[5 * 2**40] == "5120 GB"
    assert got[3 * 2**50] == "3072 TB"
    assert got[1] == "1 bytes"


def test_size_pretty_null(spark):
    df = spark.createDataFrame([(None,)], "b long")
    assert df.select(size_pretty("b").alias("p")).first().p is None


def test_qualified_name_quoting(spark):
    rows = [("prom_data", "coreTemp"), ("prom_data", "cpu_seconds_total"), ("My Schema", 'we"ird'), ("s", "1abc")]
    df = spark.createDataFrame(rows, "s string, n string")
    got = [r.q for r in df.select(qualified_name("s", "n").alias("q")).collect()]
    assert got == [
        'prom_data."coreTemp"',
        "prom_data.cpu_seconds_total",
        '"My Schema"."we""ird"',
        's."1abc"',
    ]


def test_epoch_ms_floors_before_1970(spark):
    df = spark.createDataFrame([("1969-12-31 23:59:59.9985",), ("2024-01-01 00:00:00.0019",), ("1970-01-01 00:00:00",)], "t string")
    df = df.select(F.col("t").cast("timestamp_ntz").alias("ts"))
    assert [r.ms for r in df.select(epoch_ms("ts").alias("ms")).collect()] == [-2, 1704067200001, 0]


def test_nan_to_null(spark):
    vals = [float("nan"), None, float("inf"), float("-inf"), 1.5]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    assert [r.v for r in df.select(nan_to_null("v").alias("v")).collect()] == [None, None, None, None, 1.5]


def test_canonical_labels_key_order(spark):
    df = spark.createDataFrame([('{"b":"2","a":"1"}',), ('{"a":"1","b":"2"}',), ('{"a":"it\'s"}',)], "l string")
    got = [r.c for r in df.select(canonical_labels("l").alias("c")).collect()]
    assert got[0] == got[1] == '{"a":"1","b":"2"}'
    assert got[2] == '{"a":"it\'s"}'


def test_sql_quote_doubles_quotes(spark):
    df = spark.createDataFrame([("{\"a\":\"it's\"}",)], "l string")
    assert df.select(sql_quote("l").alias("q")).first().q == "'{\"a\":\"it''s\"}'"


def test_buckets():
    t = dt.datetime(2024, 1, 21, 5, 0)
    assert floor_bucket(t, "1 day") == dt.datetime(2024, 1, 21)
    assert ceil_bucket(t, "1 day") == dt.datetime(2024, 1, 22)
    assert ceil_bucket(dt.datetime(2024, 1, 21), "1 day") == dt.datetime(2024, 1, 21)
    assert floor_bucket(t, "6 hours") == dt.datetime(2024, 1, 21, 0)
    with pytest.raises(ValueError):
        floor_bucket(t, "1 month")

"""Statements read back from their files: every value, and damage of any part."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from chunkwise.operators.batches import insert_statements
from chunkwise.operators.statements import rows_checksum, statement_rows, statement_tally
from chunkwise.plans.migrate import migrate_sql
from chunkwise.sources.sinks import read_text, write_insert_sql
from chunkwise.model import series_dictionary
from helpers import samples_df

SCHEMA = "metric string, ts timestamp_ntz, value double, new_series_id long"


def _rows(spark):
    rows = []
    for metric in ("click", 'odd"na\'me', "a, (b);"):
        for i in range(57):
            value = [0.0, -0.0, float("nan"), float("inf"), float("-inf"), 1e300, 5e-324, 0.1 + i][i % 8]
            rows.append((metric, dt.datetime(1969, 12, 31, 23) + dt.timedelta(minutes=7 * i, microseconds=i), value, (1 << 62) + i // 3))
        rows.append(rows[-1])  # a repeated row
    return spark.createDataFrame(rows, SCHEMA)


def _tally(spark, path):
    return {r.metric: r for r in statement_tally(read_text(spark, path), "prom_data").collect()}


def test_rows_come_back_as_they_were_written(spark, tmp_dir):
    rows = _rows(spark)
    write_insert_sql(insert_statements(rows, 10, "prom_data"), f"{tmp_dir}/sql")
    back = statement_rows(read_text(spark, f"{tmp_dir}/sql"))
    assert sorted(map(repr, back.select(*rows.columns).collect())) == sorted(map(repr, rows.collect()))
    want = rows.groupBy("metric").agg(rows_checksum(F.col("ts"), F.col("value"), F.col("new_series_id")).alias("c"))
    got = _tally(spark, f"{tmp_dir}/sql")
    assert {m: r.checksum for m, r in got.items()} == {r.metric: r.c for r in want.collect()}
    assert all((r.rows_out, r.n_statements, r.n_damaged) == (58, 6, 0) for r in got.values())


def _damage(tmp_dir, old, new):
    """Change the first occurrence in the click files."""
    for name in glob.glob(f"{tmp_dir}/sql/metric=click/part-*"):
        text = open(name, encoding="utf-8").read()
        if old in text:
            with open(name, "w", encoding="utf-8") as f:
                f.write(text.replace(old, new, 1))
            return
    raise AssertionError(f"{old!r} isn't in the files")


SPEC = [("click", "dn1", 1, 3, 12, "a"), ("view", "dn1", 2, 3, 9, "b")]


@pytest.mark.parametrize(
    "old, new, damaged, rows",
    [
        ("'3.0'", "'4.0'", 0, 12),  # another value
        ("03:00:04.000004", "03:00:04.000005", 0, 12),  # another time
        ("'3.0'", "'x'", 0, 12),  # no number
        ("+00'", "'", 0, 12),  # no zone
        ("'), (", "') (", 1, 12),  # a separator lost
        ("(TIMESTAMPTZ '", "(TIMESTAMP '", 1, 11),  # a tuple spoilt
        (";", "", 1, 12),  # the end lost
        ("INSERT INTO prom_data", "INSERT INTO prom_dato", 1, 12),  # another table
    ],
)
def test_a_damaged_statement_fails_its_metric_alone(spark, tmp_dir, old, new, damaged, rows):
    samples = samples_df(spark, SPEC)
    args = (samples, series_dictionary(samples), None, ["click", "view"], 5, "prom_data", f"{tmp_dir}/sql")
    first = migrate_sql(*args)
    assert {r.metric: (r.state, r.n_damaged) for r in first.status.collect()} == {"click": ("ok", 0), "view": ("ok", 0)}
    _damage(tmp_dir, old, new)
    # the local file system's own checksums would notice first
    fs = spark._jvm.org.apache.hadoop.fs.Path(tmp_dir).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.setVerifyChecksum(False)
    try:
        again = {r.metric: (r.state, r.n_damaged, r.rows_out) for r in migrate_sql(*args, resume=True).status.collect()}
    finally:
        fs.setVerifyChecksum(True)
    assert again == {"click": ("failed", damaged, rows), "view": ("ok", 0, 9)}


def test_lines_without_tuples_and_no_lines(spark):
    lines = spark.createDataFrame([("INSERT INTO prom_data.\"m\" values ;", "m"), ("", "m"), (None, "n")], "value string, metric string")
    got = {r.metric: (r.rows_out, r.n_statements, r.n_damaged, r.checksum) for r in statement_tally(lines, "prom_data").collect()}
    assert got["m"] == (0, 2, 2, None)
    assert got["n"] == (0, 1, 1, None)
    assert statement_tally(lines.limit(0), "prom_data").collect() == []
    assert statement_rows(lines).collect() == []


def _line(middle, value="1.5"):
    first, second = (f"(TIMESTAMPTZ '2024-01-01 00:00:0{i}+00', '{value}', '{i}')" for i in (1, 2))
    return f'INSERT INTO prom_data."m" values {first}{middle}{second};'


def test_a_changed_separator_of_the_same_length_is_damage(spark):
    lines = spark.createDataFrame([(_line(", "), "m"), (_line(",,"), "n")], "value string, metric string")
    lines = lines.withColumn("value", F.replace("value", F.lit('"m"'), F.concat(F.lit('"'), "metric", F.lit('"'))))
    got = {r.metric: (r.rows_out, r.n_damaged) for r in statement_tally(lines, "prom_data").collect()}
    assert got == {"m": (2, 0), "n": (2, 1)}


def test_texts_with_doubled_quotes_and_brackets_are_one_text(spark):
    lines = spark.createDataFrame([(_line(", ", text), "m") for text in ("1''5", "2.5'', (''x", "", "-Infinity")], "value string, metric string")
    got = sorted((r.new_series_id, repr(r.value), r.ts.second) for r in statement_rows(lines).collect())
    assert got == sorted((i, v, i) for i in (1, 2) for v in ("None", "None", "None", "-inf"))
    assert [(r.rows_out, r.n_damaged) for r in statement_tally(lines, "prom_data").collect()] == [(8, 0)]


def test_the_statement_pattern_runs_once_a_statement_and_sums_need_no_decimals(spark):
    lines = spark.createDataFrame([(_line(", "), "m")], "value string, metric string")
    plan = statement_tally(lines, "prom_data")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and "decimal" not in plan
    # tuples without a doubled quote are cut, not matched again
    assert plan.count("split(") == 1

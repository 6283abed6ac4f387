"""Ledgers of runs: which lines a store took (S10), which metrics are written.

A ledger is a folder of Parquet parts that only grows; a part is committed by Spark's
own write, so a failed job leaves nothing in it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import materialize
from .readers import path_exists
from .sinks import PUSH_SCHEMA, Transport, push_jsonl

METRIC_LEDGER = "metric string, state string, error string, at timestamp"


def read_ledger(spark: SparkSession, path: str, schema: str = PUSH_SCHEMA) -> DataFrame:
    """All committed entries, of all runs; empty before the first run."""
    entries = spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
    return entries.drop("run")


def delivered_lines(ledger: DataFrame) -> DataFrame:
    """(metric, line_key) of the lines that some request delivered (2xx)."""
    taken = ledger.where("status BETWEEN 200 AND 299")
    return taken.select("metric", F.explode("line_keys").alias("line_key")).distinct()


def pending_lines(lines: DataFrame, ledger: DataFrame) -> DataFrame:
    """The (metric, line) rows that no request delivered yet.

    The line's key is the digest of its text. Keys alone meet the ledger; the lines are
    then matched with the keys left over, whose measured size decides whether adaptive
    execution broadcasts them, so after a nearly complete run no text is shuffled.
    """
    keyed = lines.select("metric", "line", F.md5("line").alias("line_key"))
    left = keyed.select("metric", "line_key").distinct().join(delivered_lines(ledger), ["metric", "line_key"], "left_anti")
    return keyed.join(materialize(left, "pending_keys"), ["metric", "line_key"], "left_semi").select("metric", "line")


def push_pending(
    lines: DataFrame, transport: Transport, path: str, lines_per_request: int = 1000, bytes_per_request: int = 4 << 20
) -> DataFrame:
    """S10 with a ledger at ``path``: send only lines that it doesn't hold as delivered, add
    this run's request outcomes to it and return them.

    At least once: lines of a job that failed as a whole, or of a task that ran again, may
    go twice, with equal keys. A refused line stays pending and goes again next time.
    """
    spark = lines.sparkSession
    if path_exists(spark, path):
        lines = pending_lines(lines, read_ledger(spark, path))
    # sending is a side effect: done once by this write, then read back
    run = f"{path}/run={uuid.uuid4().hex}"
    push_jsonl(lines, transport, lines_per_request, bytes_per_request).write.parquet(run)
    return spark.read.schema(PUSH_SCHEMA).parquet(run)


def finished_metrics(spark: SparkSession, path: str) -> set[str]:
    """Metrics whose newest entry is ok. The names are a literal parameter of the runs."""
    newest = read_ledger(spark, path, METRIC_LEDGER).groupBy("metric").agg(F.max_by("state", "at").alias("state"))
    return {r["metric"] for r in newest.where("state = 'ok'").collect()}


def enter_metrics(spark: SparkSession, path: str, states: dict[str, str | None]) -> None:
    """Commit one entry per metric: ok, or failed with the error's first line."""
    rows = [(m, "ok" if error is None else "failed", error) for m, error in states.items()]
    if rows:
        entries = spark.createDataFrame(rows, "metric string, state string, error string").withColumn("at", F.current_timestamp())
        entries.coalesce(1).write.mode("append").parquet(path)

"""Sinks (S8-S10): JSON lines, INSERT statement files and the push to a
metrics store.

A rerun replaces the listed metrics' files instead of appending duplicates.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import clear_metrics, metric_folders

# The push runs Python on the executors. Functions and classes of this module
# travel by value, so executors need no copy of the package to run them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


TEXT_SCHEMA = "value string, metric string"


def _write_text(df: DataFrame, col: str, path: str, metrics: Iterable[str] | None) -> None:
    """The listed metrics' folders are emptied first: a metric without rows in this run
    leaves none of an earlier one. Rows of a metric are brought together before the
    write, in parts of a size that adaptive execution chooses, so files aren't small."""
    rows = df.select("metric", F.col(col).alias("value"))
    if metrics is None:
        writer = rows.hint("rebalance", "metric").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        clear_metrics(df.sparkSession, path, metrics)
        writer = rows.hint("rebalance", "metric").write.mode("append")
    writer.partitionBy("metric").text(path)


def read_text(spark: SparkSession, path: str, metrics: Iterable[str] | None = None) -> DataFrame:
    """Lines that were written, of the listed metrics: (metric, value). The schema is
    given, so that nothing written reads as an empty table and names stay text."""
    if not metric_folders(spark, path):  # without one, the reader knows no metric column
        return spark.createDataFrame([], TEXT_SCHEMA)
    rows = spark.read.schema(TEXT_SCHEMA).text(path)
    return rows if metrics is None else rows.filter(F.col("metric").isin(list(metrics)))


def write_jsonl(lines: DataFrame, path: str, metrics: Iterable[str] | None = None) -> None:
    """One JSON object per line, one folder per metric."""
    _write_text(lines, "line", path, metrics)


def write_insert_sql(statements: DataFrame, path: str, metrics: Iterable[str] | None = None) -> None:
    """One INSERT statement per line, one folder per metric."""
    _write_text(statements, "statement", path, metrics)


Transport = Callable[[str, list[str]], int]


def push_jsonl(lines: DataFrame, transport: Transport, lines_per_request: int = 1000, bytes_per_request: int = 4 << 20) -> DataFrame:
    """Send JSON lines to a metrics store through ``transport(metric, lines)``,
    which returns an HTTP-like status code.

    Runs on the executors (``mapInPandas``); every request's outcome comes back
    as a row ``(metric, request, n_lines, n_bytes, line_keys, status)``. A request has at
    most ``lines_per_request`` lines and, unless one line is longer,
    ``bytes_per_request`` bytes. A line is one batch of one series, and its key is the
    digest of its text: it doesn't depend on partitions, so lines that a retried task
    or a rerun sent twice (at-least-once) have the same key in both outcomes.
    The transport is injected: the library opens no connection itself.
    """
    if lines_per_request < 1 or bytes_per_request < 1:
        raise ValueError("lines_per_request and bytes_per_request must be >= 1")

    def requests(body: list[str]) -> Iterator[list[str]]:
        part, held = [], 0
        for line in body:
            size = len(line.encode()) + 1
            if part and (len(part) >= lines_per_request or held + size > bytes_per_request):
                yield part
                part, held = [], 0
            part.append(line)
            held += size
        if part:
            yield part

    def send(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for pdf in batches:
            out = []
            for metric, grp in pdf.groupby("metric", sort=True):
                for part in requests(grp["line"].tolist()):
                    keys = [hashlib.md5(line.encode()).hexdigest() for line in part]
                    status = int(transport(str(metric), part))
                    name = f"{metric}:{hashlib.md5(''.join(keys).encode()).hexdigest()}"
                    out.append((metric, name, len(part), sum(len(x.encode()) + 1 for x in part), keys, status))
            if out:
                yield pd.DataFrame(out, columns=["metric", "request", "n_lines", "n_bytes", "line_keys", "status"])

    return lines.select("metric", "line").mapInPandas(send, PUSH_SCHEMA)


PUSH_SCHEMA = "metric string, request string, n_lines long, n_bytes long, line_keys array<string>, status int"


def failed_requests(status: DataFrame) -> DataFrame:
    return status.filter((F.col("status") < 200) | (F.col("status") >= 300))


class StubTransport:
    """In-process stand-in for a metrics store: answers every request with a
    fixed status (``fail`` for the listed metrics); opens no connection."""

    def __init__(self, ok: int = 204, fail: int = 500, failing_metrics: Iterable[str] = ()):
        self.ok, self.fail, self.failing = ok, fail, frozenset(failing_metrics)

    def __call__(self, metric: str, lines: list[str]) -> int:
        return self.fail if metric in self.failing else self.ok

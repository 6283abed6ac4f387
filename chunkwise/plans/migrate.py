"""Whole migration flows (W1, W2): all listed metrics in one job each.

The metric list is a key of the job, not a loop; status rows per metric
replace the print-and-continue error handling.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import materialize
from ..functions.labels import valid_labels
from ..functions.scalar import is_non_finite
from ..operators.batches import batch_records, insert_statements, json_lines
from ..operators.series import get_or_create_series, id_map, rejected_labels, remap_with
from ..operators.statements import rows_checksum, statement_tally
from ..sources.ledger import enter_metrics, finished_metrics, push_pending
from ..sources.sinks import PUSH_SCHEMA, Transport, failed_requests, push_jsonl, read_text, write_insert_sql, write_jsonl
from ..sources.target_store import TARGET_SCHEMA, allocate_series, read_target


def _names_df(samples: DataFrame, names: list[str]) -> DataFrame:
    return samples.sparkSession.createDataFrame([(n,) for n in names], "metric string")


def failed_metrics(series: DataFrame) -> DataFrame:
    """(metric, n_bad_labels) of the metrics with label texts that are no label set. They
    are left out of the run and reported; the others go on."""
    bad = series.where(~valid_labels("labels"))
    return bad.groupBy("metric").agg(F.count(F.lit(1)).alias("n_bad_labels"))


COUNTS = ("rows_in", "rows_out", "n_missing_labels", "n_non_finite", "n_bad_labels")


def write_metrics(spark: SparkSession, names: list[str], ledger: str, resume: bool, write: Callable[[list[str]], None]) -> dict[str, str]:
    """Write the metrics in one job, or around those that fail: a list whose job fails is
    halved and tried again, so that a metric with values that can't be read or written ends
    up alone while all others are written. Each outcome is an entry of the ledger; with
    ``resume``, metrics whose newest entry is ok aren't touched. Returns metric -> error.
    """
    done = finished_metrics(spark, ledger) if resume else set()
    states: dict[str, str | None] = {}

    def attempt(part: list[str]) -> None:
        if not part:
            return
        try:
            write(part)
        except (PySparkException, Py4JJavaError) as e:
            if len(part) == 1:
                states[part[0]] = (str(e).splitlines() or [type(e).__name__])[0]
                enter_metrics(spark, ledger, {part[0]: states[part[0]]})
                return
            attempt(part[: len(part) // 2])
            attempt(part[len(part) // 2 :])
            return
        states.update(dict.fromkeys(part))
        enter_metrics(spark, ledger, dict.fromkeys(part))

    attempt([n for n in names if n not in done])
    return {m: error for m, error in states.items() if error is not None}


def migration_status(
    selected: DataFrame, known: DataFrame, bad: DataFrame, names: list[str], written: DataFrame, errors: Iterable[str] = ()
) -> DataFrame:
    """One row per listed metric: rows in; rows out, as found in what was written
    (``written``: metric, rows_out, more counts); samples whose series has no labels;
    non-finite values (sent as NaN text / null); bad label texts; and ``state``: failed for
    a metric with bad labels or rows neither written nor accounted for, else ok. A metric
    in ``errors`` failed while it was written: its counts are 0, its values aren't read.

    With the target ids in ``known`` (``new_series_id``) and a ``checksum`` of what was
    written, the rows' contents are compared as well, in the same pass over the samples:
    a metric whose times, values or ids differ is failed, and so is one with
    ``n_damaged`` texts that aren't fully read."""
    errors = list(errors)
    if errors:
        selected = selected.where(~F.col("metric").isin(errors))
    ids = [c for c in ("new_series_id",) if c in known.columns]
    j = selected.select("metric", "series_id", "ts", "value").join(known.select("series_id", F.lit(True).alias("_k"), *ids), "series_id", "left")
    sums = [rows_checksum(F.col("ts"), F.col("value"), F.col(c), F.col(c).isNotNull()).alias("checksum_in") for c in ids]
    stats = j.groupBy("metric").agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count(F.when(F.col("_k").isNull(), F.lit(1))).alias("n_missing_labels"),
        F.count(F.when(is_non_finite("value"), F.lit(1))).alias("n_non_finite"),
        *sums,
    )
    more = [c for c in written.columns if c not in ("metric", "rows_out", "checksum")]
    out = _names_df(selected, names).join(stats, "metric", "left").join(written, "metric", "left").join(bad, "metric", "left")
    equal = F.col("checksum_in").eqNullSafe(F.col("checksum")) if ids and "checksum" in written.columns else F.lit(True)
    out = out.select("metric", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (*COUNTS, *more)], equal.alias("_equal"))
    done = F.col("_equal") & (F.col("n_bad_labels") == 0) & (F.col("rows_out") + F.col("n_missing_labels") == F.col("rows_in"))
    done = done & (F.col("n_damaged") == 0) if "n_damaged" in more else done
    done = done & ~F.col("metric").isin(errors) if errors else done
    return out.withColumn("state", F.when(done, "ok").otherwise("failed")).drop("_equal")


@dataclass
class SqlMigration:
    remapped: DataFrame
    status: DataFrame
    new_target: DataFrame
    mapping: DataFrame
    rejected: DataFrame
    size: int
    schema: str
    errors: dict[str, str] = field(default_factory=dict)

    @property
    def statements(self) -> DataFrame:
        """The batched INSERT statements (planned on first use)."""
        return insert_statements(self.remapped, self.size, self.schema)


def migrate_sql(
    samples: DataFrame,
    series: DataFrame,
    target_series: DataFrame | str | None,
    metrics: Iterable[str],
    size: int,
    schema: str,
    path: str | None = None,
    resume: bool = False,
) -> SqlMigration:
    """Samples of the listed metrics -> target series ids -> batched INSERT
    statement files (one folder per metric, rerun-safe).

    ``target_series`` given as a path is the stored dictionary of the target: the ids
    that this run creates are added to it before any statement is written, so the next
    run, of this or other metrics, finds them and none is given twice. A path that
    doesn't exist yet, and None, are a target without series. Runs may create ids in one
    stored target at the same time.

    A metric that fails while it is written is reported (``errors``, state failed) and the
    others go on; with ``resume``, metrics that an earlier run into ``path`` finished stay
    as they are and only the rest is written. The status reads all listed metrics' files
    back and compares every row in them with the samples, so files that were damaged after
    an earlier run show as failed too; a run without ``resume`` writes them anew.
    """
    spark = samples.sparkSession
    names = list(dict.fromkeys(metrics))
    selected = samples.filter(F.col("metric").isin(names))
    # the labels snapshot of the listed metrics and the old -> new id table are
    # written once and read by every branch below (statements, status)
    sel_series = materialize(series.filter(F.col("metric").isin(names)))
    bad = materialize(failed_metrics(sel_series), "bad_metrics")
    good_series = sel_series.join(bad.select("metric"), "metric", "left_anti")
    if isinstance(target_series, str):
        mapping = allocate_series(spark, good_series, target_series)
        new_target = read_target(spark, target_series)
    else:
        target = spark.createDataFrame([], TARGET_SCHEMA) if target_series is None else target_series
        mapping, _ = get_or_create_series(good_series.select("labels"), target)
        mapping = materialize(mapping, "mapping")
        created = mapping.filter("created").select("labels", "series_id")
        new_target = target.select("labels", F.col("series_id").cast("long").alias("series_id")).unionByName(created)
    ids = materialize(id_map(good_series, mapping), "ids")
    remapped = remap_with(selected, ids)
    run = SqlMigration(remapped, None, new_target, mapping, rejected_labels(sel_series), size, schema)
    if path is not None:

        def statements_of(part: list[str]) -> DataFrame:
            # target ids are looked up for the rows written, not to count them and only for sampled ones
            return insert_statements(selected.where(F.col("metric").isin(part)), size, schema, prepare=lambda rows: remap_with(rows, ids))

        run.errors = write_metrics(
            spark, names, f"{path.rstrip('/')}/_ledger", resume, lambda part: write_insert_sql(statements_of(part), path, part)
        )
        written = statement_tally(read_text(spark, path, names), schema)
        known = sel_series.select("series_id").distinct().join(ids, "series_id", "left")
    else:
        written = remapped.groupBy("metric").agg(F.count(F.lit(1)).alias("rows_out"))
        known = sel_series
    run.status = migration_status(selected, known, bad, names, written, run.errors)
    return run


@dataclass
class JsonMigration:
    lines: DataFrame
    push_status: DataFrame
    status: DataFrame
    errors: dict[str, str] = field(default_factory=dict)


def migrate_jsonl(
    samples: DataFrame,
    series: DataFrame,
    metrics: Iterable[str],
    size: int,
    path: str,
    transport: Transport | None = None,
    lines_per_request: int = 1000,
    raise_on_reject: bool = False,
    bytes_per_request: int = 4 << 20,
    resume: bool = False,
) -> JsonMigration:
    """Labels join, per-series batches, JSON lines written per metric, then
    pushed from the written files of the listed metrics. Nothing is removed here; the
    caller drops the run folder (``readers.drop_folder``) only after ``status`` shows no
    rejected request.

    A metric that fails while it is written is reported (``errors``, state failed) and the
    others go on. With ``resume``, metrics that an earlier run into ``path`` finished aren't
    written again, and only lines that no resuming run delivered yet are sent."""
    spark = samples.sparkSession
    names = list(dict.fromkeys(metrics))
    selected = samples.filter(F.col("metric").isin(names))
    sel_series = materialize(series.filter(F.col("metric").isin(names)))
    bad = materialize(failed_metrics(sel_series), "bad_metrics")
    good_series = sel_series.join(bad.select("metric"), "metric", "left_anti")
    # a metric with bad labels is left out, with all of its series
    usable = selected.join(bad.select("metric"), "metric", "left_anti")

    def lines_of(part: list[str]) -> DataFrame:
        records = batch_records(usable.where(F.col("metric").isin(part)), good_series, size)
        return json_lines(records.join(good_series.select("series_id", "metric"), "series_id"))

    errors = write_metrics(
        spark, names, f"{path.rstrip('/')}/_ledger", resume, lambda part: write_jsonl(lines_of(part), path, part)
    )
    written = read_text(spark, path, names).select("metric", F.col("value").alias("line"))
    if transport is None:
        push = spark.createDataFrame([], PUSH_SCHEMA)
    elif resume:
        push = push_pending(written, transport, f"{path.rstrip('/')}_push_ledger", lines_per_request, bytes_per_request)
    else:
        # the push is a side effect: run it once, keep its outcome as a table
        status_path = path.rstrip("/") + "_push_status"
        push_jsonl(written, transport, lines_per_request, bytes_per_request).write.mode("overwrite").parquet(status_path)
        push = spark.read.parquet(status_path)
    points = F.size(F.from_json("line", "struct<timestamps:array<long>>")["timestamps"])
    sent = written.groupBy("metric").agg(F.sum(points).alias("rows_out"), F.count(F.lit(1)).alias("n_lines"))
    rejected = failed_requests(push).groupBy("metric").agg(F.sum("n_lines").alias("n_rejected"))
    status = migration_status(selected, sel_series, bad, names, sent.join(rejected, "metric", "left"), errors)
    if raise_on_reject:
        refused = [r["metric"] for r in status.filter(F.col("n_rejected") > 0).select("metric").collect()]
        if refused:
            raise RuntimeError(f"metrics store rejected lines of {sorted(refused)}; request outcomes kept in the push status")
    return JsonMigration(written, push, status, errors)

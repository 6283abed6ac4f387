"""Registered series, batching, export and migration queries."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from ..config import Params, materialize, work_dir
from ..functions.labels import canonical_labels, labels_map
from ..functions.scalar import epoch_ms, nan_to_null
from ..model import load_samples, samples_from_lineitem, series_dictionary, table
from ..operators import batches as B
from ..operators import series as J
from ..operators.statements import rows_checksum, statement_rows, statement_tally
from ..operators.stored_series import store_by_series, stored_remapped_samples, stored_samples_with_labels
from ..sources.readers import metric_filter, metrics_dictionary, snapshot_series
from ..sources.ledger import METRIC_LEDGER, push_pending, read_ledger
from ..sources.sinks import StubTransport, read_text, write_insert_sql
from ..sources.target_store import allocate_series, read_target
from . import migrate as W
from . import sql_common as S
from .fixtures import MIGRATION_METRICS, target_series
from .registry import REGISTRY, register

PRM = Params()
METRIC = "click"
SIZE = PRM.batch_size
ROWS_PER_SLOT = 1000  # small, so that the driver's tables have series in several slots
ROWS_PER_SLICE = 2000  # likewise: keys cut into several runs
FILTER_NAMES = ["click", "purchase", "nosuch"]

SERIES_CTE = "series AS (SELECT DISTINCT series_id, metric, labels FROM samples)"
MAPPING_CTES = (
    "target AS (SELECT DISTINCT labels, " + S.md5_num("labels", 12) + " AS series_id "
    "FROM series WHERE CAST(json_extract_string(labels, '$.user') AS BIGINT) % 3 = 0),"
    "wanted AS (SELECT DISTINCT labels FROM series),"
    "created AS (SELECT labels, (SELECT coalesce(max(series_id), 0) FROM target) + "
    "row_number() OVER (ORDER BY substr(md5(labels), 1, 3), labels) AS series_id "
    "FROM (SELECT labels FROM wanted WHERE labels NOT IN (SELECT labels FROM target)) n),"
    "mapping AS (SELECT w.labels, t.series_id, false AS created FROM wanted w JOIN target t USING (labels) "
    "UNION ALL SELECT labels, series_id, true FROM created)"
)
SERIES_BASE = S.with_ctes(S.SAMPLES_CTE, SERIES_CTE)
MAPPING_BASE = S.with_ctes(S.SAMPLES_CTE, SERIES_CTE, MAPPING_CTES)
BATCHED_CTE = (
    ", batched AS (SELECT s.series_id, s.ts, s.value, "
    f"(row_number() OVER (PARTITION BY s.series_id ORDER BY s.ts, s.value) - 1) // {SIZE} AS batch FROM samples s)"
)
MS = "((epoch_us(ts) - ((epoch_us(ts) % 1000) + 1000) % 1000) // 1000)"
RECORDS_CTE = (
    ", records AS (SELECT b.series_id, b.batch, count(*)::BIGINT AS n, "
    f"min({MS}) AS first_ms, max({MS}) AS last_ms, "
    "list(CASE WHEN isnan(value) OR isinf(value) THEN NULL ELSE value END ORDER BY ts, value) AS vals, "
    f"list({MS} ORDER BY ts, value) AS tss FROM batched b GROUP BY b.series_id, b.batch)"
)


def _series(spark, sf_dir, reused: bool = True):
    """Samples and their series dictionary; a dictionary that several branches
    read is materialised once (the labels snapshot of the reference) instead of
    being derived from the samples per branch."""
    samples = load_samples(spark, sf_dir)
    series = series_dictionary(samples)
    return samples, materialize(series) if reused else series


def _reversed_keys(labels: str):
    return F.to_json(F.map_from_entries(F.reverse(F.map_entries(labels_map(labels)))))


def _mapping(spark, sf_dir):
    samples, series = _series(spark, sf_dir)
    mapping, _ = J.get_or_create_series(series.select("labels"), target_series(series))
    return samples, series, materialize(mapping, "mapping")


# --- sources ----------------------------------------------------------------------


@register(
    "metric_filter",
    S.with_ctes(S.SAMPLES_CTE) + ", metrics AS (SELECT metric, row_number() OVER (ORDER BY substr(md5(metric), 1, 3), metric)::BIGINT "
    "AS metric_id FROM (SELECT DISTINCT metric FROM samples) m) "
    "SELECT m.metric_id, n.metric, coalesce(c.n_samples, 0)::BIGINT AS n_samples FROM (VALUES "
    + ", ".join(f"('{n}')" for n in FILTER_NAMES)
    + ") n(metric) LEFT JOIN metrics m USING (metric) LEFT JOIN (SELECT metric, count(*) AS n_samples FROM samples "
    "GROUP BY metric) c USING (metric)",
)
def q_metric_filter(spark, sf_dir):
    samples = load_samples(spark, sf_dir)
    _, status = metric_filter(samples, metrics_dictionary(samples), FILTER_NAMES)
    return status


@register("series_snapshot", SERIES_BASE + f"SELECT series_id, metric, labels FROM series WHERE metric = '{METRIC}'")
def q_series_snapshot(spark, sf_dir):
    _, series = _series(spark, sf_dir, reused=False)
    path = work_dir(spark, "series_snapshot")
    snapshot_series(spark, series, path, [METRIC])
    # a second call finds the partition present and keeps it as it is
    return snapshot_series(spark, series, path, [METRIC])


# --- series ------------------------------------------------------------------------


@register(
    "samples_with_labels",
    SERIES_BASE + "SELECT s.ts, s.series_id, s.metric, CAST(s.value AS DOUBLE) AS value, d.labels FROM samples s JOIN series d USING (series_id) "
    "WHERE user_id % 5 <> 0",
)
def q_samples_with_labels(spark, sf_dir):
    """A dictionary with some series twice, their keys in another order, and some missing:
    the join doubles no sample and drops those without labels."""
    samples, some = _some_labels(spark, sf_dir)
    return J.samples_with_labels(samples, some).select("ts", "series_id", "metric", "value", "labels")


def _some_labels(spark, sf_dir):
    samples, series = _series(spark, sf_dir, reused=False)
    user = F.get_json_object("labels", "$.user").cast("long")
    again = series.where(user % 2 == 1).withColumn("labels", _reversed_keys("labels"))
    return samples, series.unionByName(again).where(user % 5 != 0)


@register("samples_with_labels_stored", REGISTRY["samples_with_labels"].sql)
def q_samples_with_labels_stored(spark, sf_dir):
    """The same from tables stored by series: the join shuffles no sample."""
    stored = store_by_series(*_some_labels(spark, sf_dir), rows_per_slot=ROWS_PER_SLOT)
    return stored_samples_with_labels(stored).select("ts", "series_id", "metric", "value", "labels")


@register("distinct_series", S.with_ctes(S.SAMPLES_CTE) + f"SELECT DISTINCT series_id FROM samples WHERE metric = '{METRIC}'")
def q_distinct_series(spark, sf_dir):
    return J.series_ids(load_samples(spark, sf_dir), METRIC)


@register("canonical_labels", SERIES_BASE + "SELECT DISTINCT labels AS labels_canonical FROM samples")
def q_canonical_labels(spark, sf_dir):
    samples = load_samples(spark, sf_dir)
    # odd users carry their labels with the keys in reverse order
    raw = samples.select(F.when(F.col("user_id") % 2 == 1, _reversed_keys("labels")).otherwise(F.col("labels")).alias("labels"))
    return raw.select(canonical_labels("labels").alias("labels_canonical")).distinct()


@register("get_or_create_series", MAPPING_BASE + "SELECT labels, series_id, created FROM mapping")
def q_get_or_create_series(spark, sf_dir):
    return _mapping(spark, sf_dir)[2]


@register(
    "remapped_samples",
    MAPPING_BASE + "SELECT s.ts, m.series_id AS new_series_id, s.metric, CAST(s.value AS DOUBLE) AS value FROM samples s JOIN mapping m USING (labels)",
)
def q_remapped_samples(spark, sf_dir):
    samples, series, mapping = _mapping(spark, sf_dir)
    return J.remap_samples(samples, series, mapping).select("ts", "new_series_id", "metric", "value")


@register("remapped_samples_stored", REGISTRY["remapped_samples"].sql)
def q_remapped_samples_stored(spark, sf_dir):
    samples, series, mapping = _mapping(spark, sf_dir)
    stored = store_by_series(samples, series, rows_per_slot=ROWS_PER_SLOT)
    return stored_remapped_samples(stored, mapping).select("ts", "new_series_id", "metric", "value")


def _created_sql(metric: str, target: str) -> str:
    """Ids above the target's largest for the metric's label sets that it lacks."""
    return (
        f"(SELECT labels, (SELECT coalesce(max(series_id), 0) FROM {target}) + row_number() OVER "
        f"(ORDER BY substr(md5(labels), 1, 3), labels) AS series_id FROM (SELECT DISTINCT labels FROM series "
        f"WHERE metric = '{metric}' AND labels NOT IN (SELECT labels FROM {target})))"
    )


@register(
    "get_or_create_two_runs",
    MAPPING_BASE.rstrip() + ", first_run AS " + _created_sql("click", "target")
    + ", between AS (SELECT labels, series_id FROM target UNION ALL SELECT * FROM first_run), second_run AS "
    + _created_sql("view", "between") + " SELECT labels, series_id FROM between UNION ALL SELECT * FROM second_run",
)
def q_get_or_create_two_runs(spark, sf_dir):
    """Two migrations of different metrics against one stored target: the second finds the
    ids of the first, so none is given twice and none changes."""
    samples, series = _series(spark, sf_dir)
    path = work_dir(spark, "target")
    target_series(series).write.parquet(path)
    for metric in ("click", "view"):
        W.migrate_sql(samples, series, path, [metric], SIZE, PRM.schema)
    return read_target(spark, path)


@register(
    "get_or_create_at_once",
    MAPPING_BASE.rstrip() + ", wanted_now AS (SELECT DISTINCT labels FROM series WHERE metric IN ('click', 'view')), "
    "known AS (SELECT labels FROM target UNION SELECT labels FROM wanted_now) "
    "SELECT (SELECT count(*) FROM known)::BIGINT AS n_labels, (SELECT count(*) FROM known)::BIGINT AS n_ids, "
    "((SELECT max(series_id) FROM target) + (SELECT count(*) FROM wanted_now WHERE labels NOT IN (SELECT labels FROM target)))::BIGINT AS last_id",
)
def q_get_or_create_at_once(spark, sf_dir):
    """Two runs allocate ids in one stored target at the same time: every label set has one
    id, no id is given twice and none is left out."""
    _, series = _series(spark, sf_dir)
    path = work_dir(spark, "target")
    target_series(series).write.parquet(path)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda m: allocate_series(spark, series.where(F.col("metric") == m), path), ("click", "view")))
    return read_target(spark, path).agg(
        F.countDistinct("labels").alias("n_labels"), F.countDistinct("series_id").alias("n_ids"), F.max("series_id").alias("last_id")
    )


# --- batches and exports -----------------------------------------------------------------


@register("series_batches", S.with_ctes(S.SAMPLES_CTE) + BATCHED_CTE + " SELECT series_id, ts, CAST(value AS DOUBLE) AS value, batch FROM batched")
def q_series_batches(spark, sf_dir):
    samples = load_samples(spark, sf_dir).select("series_id", "ts", "value")
    return B.with_batches(samples, ["series_id"], ["ts", "value"], SIZE)


@register(
    "lineitem_batches",
    S.with_ctes(S.LINEITEM_SAMPLES_CTE) + "SELECT metric, ts, CAST(value AS DOUBLE) AS value, series_id, (row_number() OVER "
    "(PARTITION BY metric ORDER BY ts, value, series_id) - 1) // 1000 AS batch FROM li_samples",
)
def q_lineitem_batches(spark, sf_dir):
    """One metric whose times are all midnights, cut into many slices."""
    samples = samples_from_lineitem(table(spark, sf_dir, "lineitem")).select("metric", "ts", "value", "series_id")
    return B.with_batches(samples, ["metric"], ["ts", "value", "series_id"], 1000, rows_per_slice=ROWS_PER_SLICE)


@register(
    "batch_plan",
    S.with_ctes(S.SAMPLES_CTE) + f"SELECT metric, count(*)::BIGINT AS n_rows, ceil(count(*) / {SIZE})::BIGINT AS n_batches "
    "FROM samples GROUP BY metric",
)
def q_batch_plan(spark, sf_dir):
    return B.batch_plan(load_samples(spark, sf_dir), SIZE)


_RECORDS_SQL = (
    SERIES_BASE + BATCHED_CTE + RECORDS_CTE + " SELECT r.series_id, r.batch, r.n, r.first_ms, r.last_ms, to_json(r.vals)::VARCHAR AS values_text, d.labels "
    "FROM records r JOIN series d USING (series_id)"
)


def _record_columns(records):
    return records.select(
        "series_id",
        "batch",
        F.size("timestamps").cast("long").alias("n"),
        F.element_at("timestamps", 1).alias("first_ms"),
        F.element_at("timestamps", -1).alias("last_ms"),
        F.to_json("values").alias("values_text"),
        "labels",
    )


@register("batch_records", _RECORDS_SQL)
def q_batch_records(spark, sf_dir):
    samples, series = _series(spark, sf_dir, reused=False)
    return _record_columns(B.batch_records(samples, series, SIZE))


@register("batch_records_stitched", _RECORDS_SQL)
def q_batch_records_stitched(spark, sf_dir):
    """Series cut by many slices: batches that cross a border are put together from parts."""
    samples, series = _series(spark, sf_dir, reused=False)
    return _record_columns(B.batch_records(samples, series, SIZE, rows_per_slice=ROWS_PER_SLICE // 10))


@register(
    "jsonl_export",
    SERIES_BASE + BATCHED_CTE + RECORDS_CTE + " SELECT r.series_id, r.batch, '{\"metric\":' || d.labels || "
    "',\"values\":' || to_json(r.vals) || ',\"timestamps\":' || to_json(r.tss) || '}' AS line "
    "FROM records r JOIN series d USING (series_id)",
)
def q_jsonl_export(spark, sf_dir):
    samples, series = _series(spark, sf_dir, reused=False)
    return B.json_lines(B.batch_records(samples, series, SIZE)).select("series_id", "batch", "line")


_VALUE_TEXT = "CASE WHEN isnan(value) THEN 'NaN' WHEN value = 'Infinity'::DOUBLE THEN 'Infinity' " \
    "WHEN value = '-Infinity'::DOUBLE THEN '-Infinity' ELSE CAST(value AS VARCHAR) END"


@register(
    "insert_sql_export",
    MAPPING_BASE + ", rows AS (SELECT s.metric, s.ts, s.value, m.series_id AS new_series_id, "
    f"(row_number() OVER (PARTITION BY s.metric ORDER BY s.ts, s.value, m.series_id) - 1) // {SIZE} AS batch "
    "FROM samples s JOIN mapping m USING (labels)) "
    "SELECT metric, batch, count(*)::BIGINT AS n, 'INSERT INTO prom_data.\"' || replace(metric, '\"', '\"\"') || '\" values ' || "
    "string_agg('(TIMESTAMPTZ ''' || CAST(ts AS VARCHAR) || '+00'', ''' || replace(" + _VALUE_TEXT + ", '''', '''''') || "
    "''', ''' || CAST(new_series_id AS VARCHAR) || ''')', ', ' ORDER BY ts, value, new_series_id) || ';' AS statement "
    "FROM rows GROUP BY metric, batch",
)
def q_insert_sql_export(spark, sf_dir):
    samples, series, mapping = _mapping(spark, sf_dir)
    rows = J.remap_samples(samples, series, mapping)
    return B.insert_statements(rows, SIZE, PRM.schema)


@register(
    "insert_sql_files",
    MAPPING_BASE + ", rows AS (SELECT s.metric, s.ts, s.value, m.series_id AS new_series_id, "
    f"(row_number() OVER (PARTITION BY s.metric ORDER BY s.ts, s.value, m.series_id) - 1) // {SIZE} AS batch "
    "FROM samples s JOIN mapping m USING (labels)) "
    "SELECT metric, count(DISTINCT batch)::BIGINT AS n_statements, count(*)::BIGINT AS n_rows FROM rows GROUP BY metric",
)
def q_insert_sql_files(spark, sf_dir):
    """S9's files read back: statements and row tuples of each metric."""
    samples, series, mapping = _mapping(spark, sf_dir)
    path = work_dir(spark, "sql")
    write_insert_sql(B.insert_statements(J.remap_samples(samples, series, mapping), SIZE, PRM.schema), path)
    tuples = F.size(F.split("value", r"\(TIMESTAMPTZ '")) - 1
    return read_text(spark, path).groupBy("metric").agg(F.count(F.lit(1)).alias("n_statements"), F.sum(tuples).cast("long").alias("n_rows"))


@register("insert_sql_values", REGISTRY["remapped_samples"].sql)
def q_insert_sql_values(spark, sf_dir):
    """The rows that the written statements insert, parsed from the files."""
    samples, series, mapping = _mapping(spark, sf_dir)
    path = work_dir(spark, "sql")
    write_insert_sql(B.insert_statements(J.remap_samples(samples, series, mapping), SIZE, PRM.schema), path)
    return statement_rows(read_text(spark, path)).select("ts", "new_series_id", "metric", "value")


@register(
    "statements_checked",
    MAPPING_BASE + f"SELECT metric, count(*)::BIGINT AS rows_out, 0::BIGINT AS n_damaged, metric <> '{METRIC}' AS same_rows "
    "FROM samples JOIN mapping USING (labels) GROUP BY metric",
)
def q_statements_checked(spark, sf_dir):
    """Written statements against the samples, after two rows of one metric have changed ids
    with each other: the counts stay as they were, the contents don't."""
    samples, series, mapping = _mapping(spark, sf_dir)
    rows = J.remap_samples(samples, series, mapping)
    path = work_dir(spark, "sql")
    ends = rows.where(F.col("metric") == METRIC).agg(F.min("new_series_id").alias("lo"), F.max("new_series_id").alias("hi")).first()
    given = F.col("new_series_id")
    swapped = F.when(given == ends["lo"], ends["hi"]).when(given == ends["hi"], ends["lo"]).otherwise(given)
    changed = rows.withColumn("new_series_id", F.when(F.col("metric") == METRIC, swapped).otherwise(given))
    write_insert_sql(B.insert_statements(changed, SIZE, PRM.schema), path)
    expected = rows.groupBy("metric").agg(rows_checksum(F.col("ts"), F.col("value"), given).alias("expected"))
    found = statement_tally(read_text(spark, path), PRM.schema).join(expected, "metric")
    return found.select("metric", "rows_out", "n_damaged", F.col("checksum").eqNullSafe(F.col("expected")).alias("same_rows"))


# the flows below run with a dictionary that lacks some series
_LACKING = "user_id % 7 <> 0"
_FLOW_CTES = (
    ", known AS (SELECT * FROM samples WHERE " + _LACKING + "), stats AS (SELECT metric, count(*)::BIGINT AS rows_in, "
    "count(*) FILTER (WHERE NOT (" + _LACKING + "))::BIGINT AS n_missing_labels, "
    "count(*) FILTER (WHERE value IS NULL OR isnan(value) OR isinf(value))::BIGINT AS n_non_finite FROM samples GROUP BY metric), "
    "outs AS (SELECT metric, count(*)::BIGINT AS rows_out FROM known GROUP BY metric), "
    f"lines AS (SELECT metric, sum(n)::BIGINT AS n_lines FROM (SELECT metric, ceil(count(*) / {SIZE}) AS n FROM known GROUP BY metric, series_id) "
    "GROUP BY metric), names AS (SELECT * FROM (VALUES " + ", ".join(f"('{m}')" for m in MIGRATION_METRICS) + ") n(metric))"
)
_FLOW_COLUMNS = (
    "SELECT n.metric, coalesce(st.rows_in, 0)::BIGINT AS rows_in, coalesce(o.rows_out, 0)::BIGINT AS rows_out, "
    "coalesce(st.n_missing_labels, 0)::BIGINT AS n_missing_labels, coalesce(st.n_non_finite, 0)::BIGINT AS n_non_finite, "
    "0::BIGINT AS n_bad_labels, 'ok' AS state"
)
_FLOW_FROM = " FROM names n LEFT JOIN stats st USING (metric) LEFT JOIN outs o USING (metric) LEFT JOIN lines l USING (metric)"
_REJECTED = "error"  # the stub store refuses this metric


def _flow(spark, sf_dir):
    samples, series = _series(spark, sf_dir)
    return samples, series.where(F.get_json_object("labels", "$.user").cast("long") % 7 != 0)


_refuse = StubTransport(failing_metrics=[_REJECTED])


@register("migration_status", SERIES_BASE.rstrip() + _FLOW_CTES + _FLOW_COLUMNS + _FLOW_FROM)
def q_migration_status(spark, sf_dir):
    samples, series = _flow(spark, sf_dir)
    run = W.migrate_sql(samples, series, target_series(series), MIGRATION_METRICS, SIZE, PRM.schema, work_dir(spark, "sql"))
    return run.status.drop("n_statements", "n_damaged")


@register(
    "migrate_status",
    SERIES_BASE.rstrip() + _FLOW_CTES + _FLOW_COLUMNS + ", coalesce(l.n_lines, 0)::BIGINT AS n_lines, "
    f"CASE WHEN n.metric = '{_REJECTED}' THEN coalesce(l.n_lines, 0) ELSE 0 END::BIGINT AS n_rejected" + _FLOW_FROM,
)
def q_migrate_status(spark, sf_dir):
    samples, series = _flow(spark, sf_dir)
    return W.migrate_jsonl(samples, series, MIGRATION_METRICS, SIZE, work_dir(spark, "jsonl"), _refuse).status


@register(
    "push_status",
    SERIES_BASE.rstrip() + _FLOW_CTES + f" SELECT metric, n_lines AS lines_sent, CASE WHEN metric = '{_REJECTED}' THEN n_lines ELSE 0 END::BIGINT "
    "AS lines_refused, n_lines AS different_lines FROM lines JOIN names USING (metric)",
)
def q_push_status(spark, sf_dir):
    """Per metric: JSON lines sent, refused (answered outside 2xx) and different by key.
    What makes up a request depends on the partitions, so requests are summed away."""
    samples, series = _flow(spark, sf_dir)
    run = W.migrate_jsonl(samples, series, MIGRATION_METRICS, SIZE, work_dir(spark, "jsonl"), _refuse, lines_per_request=100)
    ok = (F.col("status") >= 200) & (F.col("status") < 300)
    keys = run.push_status.select("metric", F.explode("line_keys").alias("k")).groupBy("metric").agg(F.countDistinct("k").alias("different_lines"))
    sent = run.push_status.groupBy("metric").agg(
        F.sum("n_lines").cast("long").alias("lines_sent"),
        F.sum(F.when(ok, 0).otherwise(F.col("n_lines"))).cast("long").alias("lines_refused"),
    )
    return sent.join(keys, "metric")


@register(
    "push_two_runs",
    SERIES_BASE.rstrip() + _FLOW_CTES + f" SELECT metric, n_lines AS sent_first, CASE WHEN metric = '{_REJECTED}' THEN n_lines ELSE 0 END::BIGINT "
    f"AS refused_first, CASE WHEN metric = '{_REJECTED}' THEN n_lines ELSE 0 END::BIGINT AS sent_second FROM lines JOIN names USING (metric)",
)
def q_push_two_runs(spark, sf_dir):
    """The store refuses a metric at first; the second push sends exactly the refused lines."""
    samples, series = _flow(spark, sf_dir)
    path, ledger = work_dir(spark, "jsonl"), work_dir(spark, "push_ledger")
    lines = W.migrate_jsonl(samples, series, MIGRATION_METRICS, SIZE, path).lines
    first = push_pending(lines, _refuse, ledger, lines_per_request=100)
    second = push_pending(lines, StubTransport(), ledger, lines_per_request=100)
    refused = F.when(F.col("status").between(200, 299), 0).otherwise(F.col("n_lines"))
    sums = first.groupBy("metric").agg(F.sum("n_lines").alias("sent_first"), F.sum(refused).cast("long").alias("refused_first"))
    again = second.groupBy("metric").agg(F.sum("n_lines").alias("sent_second"))
    return sums.join(again, "metric", "left").select("metric", "sent_first", "refused_first", F.coalesce("sent_second", F.lit(0)).cast("long").alias("sent_second"))


@register(
    "migration_resumed",
    SERIES_BASE.rstrip() + _FLOW_CTES + f" SELECT n.metric, CASE WHEN n.metric = '{_REJECTED}' THEN 'failed' ELSE 'ok' END AS state_first, 'ok' AS state_second, "
    f"coalesce(o.rows_out, 0)::BIGINT AS rows_out, CASE WHEN n.metric = '{_REJECTED}' THEN 2 ELSE 1 END::BIGINT AS n_writes FROM names n LEFT JOIN outs o USING (metric)",
)
def q_migration_resumed(spark, sf_dir):
    """One metric's values can't be read in the first run; the second writes that metric only."""
    samples, series = _flow(spark, sf_dir)
    path, target = work_dir(spark, "statements"), work_dir(spark, "target")
    broken = F.when(F.col("metric") == _REJECTED, F.raise_error(F.lit("unreadable")).cast("double")).otherwise(F.col("value"))
    first = W.migrate_sql(samples.withColumn("value", broken), series, target, MIGRATION_METRICS, SIZE, PRM.schema, path)
    state_first = materialize(first.status.select("metric", F.col("state").alias("state_first")), "first")
    second = W.migrate_sql(samples, series, target, MIGRATION_METRICS, SIZE, PRM.schema, path, resume=True)
    entries = read_ledger(spark, f"{path}/_ledger", METRIC_LEDGER).groupBy("metric").agg(F.count(F.lit(1)).alias("n_writes"))
    status = second.status.select("metric", F.col("state").alias("state_second"), "rows_out")
    return state_first.join(status, "metric").join(entries, "metric")


# --- scalar functions over the samples ------------------------------------------------


@register(
    "epoch_ms",
    "SELECT event_id, ((epoch_us(ts) - ((epoch_us(ts) % 1000) + 1000) % 1000) // 1000)::BIGINT AS ms FROM events",
)
def q_epoch_ms(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", epoch_ms("ts").alias("ms"))


@register(
    "nan_to_null",
    "SELECT event_id, CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) = 0 THEN NULL ELSE value END AS value "
    "FROM events",
)
def q_nan_to_null(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    # the canonical samples' value rule, with event_id kept
    k = F.get_json_object("props", "$.k").cast("int")
    raw = F.when(k == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return ev.select("event_id", nan_to_null(raw).alias("value"))

"""Registered compression-policy, tiering and stored-layout queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..config import Params, materialize, work_dir
from ..model import attachments_df, indexes_df, load_samples
from ..operators import chunks as C
from ..operators import compression as G
from ..operators import tiering as T
from . import mover as M
from . import sql_common as S
from .chunk_reports import CUTOFF_SQL
from .fixtures import ATTACHMENTS, INDEXES, compression_settings, compression_state
from .registry import register

PRM = Params()
KEY = ["hypertable_schema", "hypertable_name"]
MOVE_TABLES = ["click", "error", "signup", "view", "nosuch"]

_H = S.md5_num("hypertable_name")
SETTINGS_CTE = (
    ", settings AS (SELECT h.hypertable_schema, h.hypertable_name, c.attname, "
    "CASE WHEN c.attname = 'series_id' THEN 1 + hh % 2 WHEN c.attname = 'node' AND hh % 3 <> 0 THEN 2 - hh % 2 END "
    "AS segmentby_column_index, "
    "CASE WHEN c.attname = 'ts' THEN 1 WHEN c.attname = 'value' AND hh % 5 <> 0 THEN 2 END AS orderby_column_index, "
    "CASE WHEN c.attname = 'ts' THEN (hh >> 1) % 2 = 0 WHEN c.attname = 'value' AND hh % 5 <> 0 THEN (hh >> 3) % 2 = 0 END "
    "AS orderby_asc, "
    "CASE WHEN c.attname = 'ts' THEN (hh >> 2) % 2 = 0 WHEN c.attname = 'value' AND hh % 5 <> 0 THEN (hh >> 4) % 2 = 0 END "
    "AS orderby_nullsfirst "
    f"FROM (SELECT *, {_H} AS hh FROM hypertables WHERE {_H} % 7 <> 0) h, "
    "(VALUES ('series_id'), ('node'), ('ts'), ('value'), ('labels')) c(attname))"
)


def _state_cte(side: str) -> str:
    h = S.md5_num(f"'{side}:' || hypertable_name")
    return (
        f", state_{side} AS (SELECT hypertable_schema, hypertable_name, "
        f"CASE WHEN {h} % 3 = 0 THEN 0 ELSE 1 END AS compression_state FROM hypertables WHERE {h} % 11 <> 0)"
    )


_TERM = (
    "CASE WHEN orderby_asc AND NOT orderby_nullsfirst THEN attname "
    "WHEN orderby_asc AND orderby_nullsfirst THEN attname || ' NULLS FIRST' "
    "WHEN NOT orderby_asc AND orderby_nullsfirst THEN attname || ' DESC' "
    "ELSE attname || ' DESC NULLS LAST' END"
)
RULES_CTE = (
    ", ob AS (SELECT hypertable_schema, hypertable_name, string_agg(" + _TERM + ", ',' ORDER BY orderby_column_index) AS rules "
    "FROM settings WHERE orderby_column_index IS NOT NULL GROUP BY hypertable_schema, hypertable_name)"
    ", sb AS (SELECT hypertable_schema, hypertable_name, string_agg(attname, ',' ORDER BY segmentby_column_index) AS rules "
    "FROM settings WHERE segmentby_column_index IS NOT NULL GROUP BY hypertable_schema, hypertable_name)"
    ", compressed AS (SELECT hypertable_schema, hypertable_name FROM state_left "
    "WHERE hypertable_schema = 'prom_data' AND compression_state <> 0)"
)
POLICY_BASE = (
    S.BASE + "," + S.HYPERTABLES_CTE.strip() + SETTINGS_CTE + _state_cte("left") + _state_cte("right") + RULES_CTE + "\n"
)


def _catalog(spark, sf_dir):
    """The samples and their catalog, written once: every report reads that."""
    samples = load_samples(spark, sf_dir)
    return samples, materialize(C.hypertable_catalog(C.chunk_inventory(samples)), "hypertables")


def _rules(spark, sf_dir):
    samples, ht = _catalog(spark, sf_dir)
    tables = G.compressed_tables(compression_state(ht, "left"), PRM.schema)
    return samples, materialize(G.compression_rules(tables, compression_settings(ht)), "rules")


def _comma(col: str):
    return F.array_join(col, ",").alias(col)


@register("compressed_tables", POLICY_BASE + "SELECT hypertable_schema, hypertable_name FROM compressed")
def q_compressed_tables(spark, sf_dir):
    _, ht = _catalog(spark, sf_dir)
    return G.compressed_tables(compression_state(ht, "left"), PRM.schema)


@register(
    "policy_drift",
    POLICY_BASE + "SELECT coalesce(l.hypertable_schema, r.hypertable_schema) AS hypertable_schema, "
    "coalesce(l.hypertable_name, r.hypertable_name) AS hypertable_name, l.compression_state AS state_left, "
    "r.compression_state AS state_right, CASE WHEN l.hypertable_name IS NULL THEN 'missing_left' "
    "WHEN r.hypertable_name IS NULL THEN 'missing_right' WHEN l.compression_state = r.compression_state THEN 'same' "
    "ELSE 'differs' END AS status FROM state_left l FULL OUTER JOIN state_right r "
    "ON l.hypertable_schema = r.hypertable_schema AND l.hypertable_name = r.hypertable_name",
)
def q_policy_drift(spark, sf_dir):
    _, ht = _catalog(spark, sf_dir)
    return G.policy_drift(compression_state(ht, "left"), compression_state(ht, "right"))


@register("orderby_rules", POLICY_BASE + "SELECT hypertable_schema, hypertable_name, rules FROM ob")
def q_orderby_rules(spark, sf_dir):
    _, ht = _catalog(spark, sf_dir)
    return G.orderby_rules(compression_settings(ht)).select(*KEY, F.array_join("orderby", ",").alias("rules"))


@register("segmentby_rules", POLICY_BASE + "SELECT hypertable_schema, hypertable_name, rules FROM sb")
def q_segmentby_rules(spark, sf_dir):
    _, ht = _catalog(spark, sf_dir)
    return G.segmentby_rules(compression_settings(ht)).select(*KEY, F.array_join("segmentby", ",").alias("rules"))


@register(
    "compression_rules",
    POLICY_BASE + "SELECT c.hypertable_schema, c.hypertable_name, coalesce(ob.rules, '') AS orderby, "
    "coalesce(sb.rules, '') AS segmentby FROM compressed c LEFT JOIN ob USING (hypertable_schema, hypertable_name) "
    "LEFT JOIN sb USING (hypertable_schema, hypertable_name)",
)
def q_compression_rules(spark, sf_dir):
    _, rules = _rules(spark, sf_dir)
    return rules.select(*KEY, _comma("orderby"), _comma("segmentby"))


_IDENT = S.qident("attname")
_DDL_TERM = _TERM.replace("attname", "q")


@register(
    "compression_ddl",
    POLICY_BASE + ", qo AS (SELECT hypertable_schema, hypertable_name, string_agg(" + _DDL_TERM + ", ', ' ORDER BY orderby_column_index) AS t "
    f"FROM (SELECT *, {_IDENT} AS q FROM settings) WHERE orderby_column_index IS NOT NULL GROUP BY ALL)"
    f", qs AS (SELECT hypertable_schema, hypertable_name, string_agg({_IDENT}, ', ' ORDER BY segmentby_column_index) AS t "
    "FROM settings WHERE segmentby_column_index IS NOT NULL GROUP BY ALL) "
    "SELECT c.hypertable_schema, c.hypertable_name, 'ALTER TABLE ' || (" + S.qident("c.hypertable_schema") + ") || '.' || ("
    + S.qident("c.hypertable_name") + ") || ' SET (timescaledb.compress' || coalesce(', timescaledb.compress_segmentby = ''' || qs.t || '''', '') "
    "|| coalesce(', timescaledb.compress_orderby = ''' || qo.t || '''', '') || ');' AS statement "
    "FROM compressed c LEFT JOIN qo USING (hypertable_schema, hypertable_name) LEFT JOIN qs USING (hypertable_schema, hypertable_name)",
)
def q_compression_ddl(spark, sf_dir):
    return G.compression_ddl(_rules(spark, sf_dir)[1])


@register(
    "layout_rows",
    POLICY_BASE + "SELECT metric, series_id, user_id, ts, CAST(value AS DOUBLE) AS value, node, labels, payload FROM samples "
    "WHERE metric IN (SELECT hypertable_name FROM compressed)",
)
def q_layout_rows(spark, sf_dir):
    samples, rules = _rules(spark, sf_dir)
    return G.apply_layout(samples, rules, work_dir(spark, "layout"))


# --- tiering --------------------------------------------------------------------------

_ATT_VALUES = ", ".join(f"('{n}', '{t}')" for n, t in ATTACHMENTS)
_IDX_VALUES = ", ".join(f"('{s}', '{t}', '{i}')" for s, t, i, _ in INDEXES)
_MOVE_LIST = ", ".join(f"'{t}'" for t in MOVE_TABLES)
MOVE_BASE = (
    S.BASE + "," + S.HYPERTABLES_CTE.strip()
    + f", att AS (SELECT h.hypertable_name, a.tier FROM hypertables h JOIN (VALUES {_ATT_VALUES}) a(hypertable_name, tier) "
    f"USING (hypertable_name) WHERE a.tier = '{PRM.tier}')"
    + f", idx AS (SELECT tablename AS hypertable_name, min(indexname) AS indexname FROM (VALUES {_IDX_VALUES}) "
    f"i(schemaname, tablename, indexname) WHERE schemaname = '{PRM.schema}' GROUP BY tablename)"
    + ", chosen AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hypertable_schema, hypertable_name "
    f"ORDER BY total_bytes DESC, chunk_name) AS rn FROM chunks WHERE range_end <= {CUTOFF_SQL} "
    f"AND hypertable_schema = '{PRM.schema}' AND hypertable_name IN ({_MOVE_LIST})) t WHERE rn = 1)"
    + ", plan AS (SELECT c.*, i.indexname FROM chosen c LEFT JOIN idx i USING (hypertable_name) "
    "WHERE c.hypertable_name IN (SELECT hypertable_name FROM att))\n"
)


def _plan(spark, sf_dir):
    """Samples and the reviewed plan, written once. Only tables with an old chunk can be
    planned, so the catalog of the old chunks serves and the age limit reaches the scan."""
    samples = load_samples(spark, sf_dir)
    plan = M.plan_moves(samples, MOVE_TABLES, attachments_df(spark, ATTACHMENTS), indexes_df(spark, INDEXES), PRM)
    return samples, materialize(plan, "move_plan")


@register("attached_tables", MOVE_BASE + "SELECT hypertable_name, tier FROM att")
def q_attached_tables(spark, sf_dir):
    _, ht = _catalog(spark, sf_dir)
    return T.attached_tables(ht, attachments_df(spark, ATTACHMENTS), PRM.tier).select("hypertable_name", "tier")


@register(
    "move_plan",
    MOVE_BASE + "SELECT hypertable_name, chunk_schema || '.' || chunk_name AS chunk, "
    f"'{PRM.tier}' AS destination_tier, '{PRM.index_tier}' AS index_destination_tier, "
    f"'{PRM.schema}.' || indexname AS reorder_index FROM plan",
)
def q_move_plan(spark, sf_dir):
    _, plan = _plan(spark, sf_dir)
    return plan.select("hypertable_name", "chunk", "destination_tier", "index_destination_tier", "reorder_index")


def _moved_sql(every: str) -> str:
    """The rows of each attached table's largest old chunk, for chunks of any width."""
    start = f"time_bucket(INTERVAL '{every}', ts, TIMESTAMP '1970-01-01')"
    return (
        S.with_ctes(S.SAMPLES_CTE) + f", placed AS (SELECT *, {start} AS range_start FROM samples), sized AS ("
        "SELECT metric, node, range_start, 40 * count(*) + coalesce(sum(strlen(payload)), 0) AS bytes FROM placed "
        f"WHERE range_start + INTERVAL '{every}' <= {CUTOFF_SQL} AND metric IN ({_MOVE_LIST}) AND metric IN "
        f"(SELECT n FROM (VALUES {_ATT_VALUES}) a(n, tier) WHERE tier = '{PRM.tier}') GROUP BY ALL), "
        "chosen AS (SELECT * FROM sized QUALIFY row_number() OVER (PARTITION BY metric ORDER BY bytes DESC, range_start, node) = 1) "
        "SELECT p.metric, p.series_id, p.user_id, p.ts, CAST(p.value AS DOUBLE) AS value, p.node, p.labels, p.payload "
        "FROM placed p JOIN chosen c USING (metric, node, range_start)"
    )


def _move(spark, sf_dir, every: str):
    """Store the hot tier by ``every``, plan and move; every chunk has to check out."""
    samples = load_samples(spark, sf_dir)
    hot, cold = work_dir(spark, "hot"), work_dir(spark, "cold")
    T.store_samples(samples, hot, every=every)
    run = M.run_chunk_mover(spark, hot, cold, MOVE_TABLES, attachments_df(spark, ATTACHMENTS), indexes_df(spark, INDEXES), replace(PRM, every=every))
    bad = run.status.filter(~F.col("ok")).count()
    if bad:
        raise RuntimeError(f"{bad} chunks differ between plan and tiers")
    return T.read_chunks(spark, cold, run.plan).select(samples.columns)


@register("moved_rows", _moved_sql("1 day"))
def q_moved_rows(spark, sf_dir):
    return _move(spark, sf_dir, "1 day")


@register("moved_rows_weekly", _moved_sql("7 days"))
def q_moved_rows_weekly(spark, sf_dir):
    return _move(spark, sf_dir, "7 days")


@register("moved_rows_6h", _moved_sql("6 hours"))
def q_moved_rows_6h(spark, sf_dir):
    return _move(spark, sf_dir, "6 hours")


def _two_widths_sql() -> str:
    columns = "metric, series_id, user_id, ts, value, node, labels, payload"
    week = _moved_sql("7 days").replace("SELECT p.metric,", "SELECT c.range_start, p.metric,")
    return f"WITH week AS ({week}) SELECT '7 days' AS width, {columns} FROM week UNION ALL SELECT '1 day' AS width, {columns} FROM week WHERE ts < range_start + INTERVAL '1 day'"


@register("moved_rows_two_widths", _two_widths_sql())
def q_moved_rows_two_widths(spark, sf_dir):
    """A week's chunk, then the day's chunk that starts with it, moved to one cold tier: each
    keeps its own folder and all of its rows."""
    samples = load_samples(spark, sf_dir)
    cold, found = work_dir(spark, "cold"), []
    attachments, indexes, week = attachments_df(spark, ATTACHMENTS), indexes_df(spark, INDEXES), None
    for every in ("7 days", "1 day"):
        params, hot = replace(PRM, every=every), work_dir(spark, "hot")
        T.store_samples(samples, hot, every=every)
        rows = spark.read.parquet(hot)
        if week is not None:  # the days that the moved weeks start with
            first = (F.col("ts") >= F.col("range_start")) & (F.col("ts") < F.col("range_start") + F.expr("INTERVAL 1 DAY"))
            starts = week.select(F.col("hypertable_name").alias("metric"), F.col("node_name").alias("node"), "range_start")
            rows = rows.join(starts, ["metric", "node"]).where(first).drop("range_start")
        plan = materialize(M.plan_moves(rows, MOVE_TABLES, attachments, indexes, params), "move_plan")
        week = plan if week is None else week
        found.append((every, plan, T.move_chunks(spark, hot, cold, plan)))
    if any(status.filter(~F.col("ok")).head(1) for _, _, status in found):
        raise RuntimeError("chunks differ between plan and tiers")
    parts = [T.read_chunks(spark, cold, plan).select(F.lit(every).alias("width"), *samples.columns) for every, plan, _ in found]
    return parts[0].unionByName(parts[1])


@register(
    "chunk_files",
    S.with_ctes(S.SAMPLES_CTE) + "SELECT metric, date_trunc('day', ts) AS range_start, node, count(*)::BIGINT AS n_rows, "
    "true AS has_bytes FROM samples GROUP BY ALL",
)
def q_chunk_files(spark, sf_dir):
    """Stored chunk folders found by C2 with the rows that their files hold; file counts and
    bytes depend on the writer and are checked against the file system in the tests."""
    path = work_dir(spark, "stored")
    T.store_samples(load_samples(spark, sf_dir), path)
    rows = spark.read.parquet(path).groupBy(*T.LAYOUT).agg(F.count(F.lit(1)).alias("n_rows"))
    files = T.chunk_files(spark, path).join(rows, T.LAYOUT, "full_outer")
    return files.select("metric", T.chunk_start(F.col("chunk")).alias("range_start"), "node", "n_rows", (F.col("file_bytes") > 0).alias("has_bytes"))

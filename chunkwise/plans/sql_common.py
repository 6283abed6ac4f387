"""DuckDB building blocks of the oracle SQL (independent of the Spark code).

The CTEs restate FIXTURES.md section 1 and the chunk model in plain SQL.
"""

SAMPLES_CTE = """
samples AS (
  SELECT event_type AS metric,
         ('0x' || substr(md5(lbl), 1, 15))::BIGINT AS series_id,
         user_id,
         ts,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) = 0
              THEN 'NaN'::DOUBLE ELSE value END AS value,
         'dn' || CAST(1 + user_id % 4 AS VARCHAR) AS node,
         lbl AS labels,
         props AS payload
  FROM (SELECT *, json_object('__name__', event_type,
                              'shard', CAST(user_id % 4 AS VARCHAR),
                              'user', CAST(user_id AS VARCHAR))::VARCHAR AS lbl
        FROM events) e
)"""

LINEITEM_SAMPLES_CTE = """
li_samples AS (
  SELECT 'lineitem_price' AS metric,
         ('0x' || substr(md5(lbl), 1, 15))::BIGINT AS series_id,
         l_suppkey AS user_id,
         CAST(l_shipdate AS TIMESTAMP) AS ts,
         l_extendedprice AS value,
         'dn' || CAST(1 + l_suppkey % 4 AS VARCHAR) AS node,
         lbl AS labels,
         concat_ws('|', l_returnflag, l_linestatus, CAST(l_orderkey AS VARCHAR)) AS payload
  FROM (SELECT *, json_object('__name__', 'lineitem_price', 'supplier', CAST(l_suppkey AS VARCHAR))::VARCHAR AS lbl
        FROM lineitem) l
)"""

CHUNKS_CTE = """
chunks AS (
  SELECT 'prom_data' AS hypertable_schema,
         metric AS hypertable_name,
         '_timescaledb_internal' AS chunk_schema,
         '_hyper_' || metric || '_' || strftime(d, '%Y%m%d') || '_' || node || '_chunk' AS chunk_name,
         node AS node_name,
         d AS range_start,
         d + INTERVAL 1 DAY AS range_end,
         n_rows,
         24 * n_rows AS table_bytes,
         16 * n_rows AS index_bytes,
         toast_bytes,
         40 * n_rows + toast_bytes AS total_bytes
  FROM (SELECT metric, node, date_trunc('day', ts) AS d,
               count(*)::BIGINT AS n_rows,
               CAST(coalesce(sum(strlen(payload)), 0) AS BIGINT) AS toast_bytes
        FROM samples GROUP BY metric, node, date_trunc('day', ts)) g
)"""

HYPERTABLES_CTE = """
hypertables AS (
  SELECT hypertable_schema, hypertable_name,
         list_sort(list(DISTINCT node_name)) AS data_nodes,
         count(*)::BIGINT AS num_chunks
  FROM chunks GROUP BY hypertable_schema, hypertable_name
)"""

NODE_SIZES_CTE = """
node_sizes AS (
  SELECT node_name AS data_node, hypertable_schema, hypertable_name,
         CAST(sum(table_bytes) AS BIGINT) AS table_bytes,
         CAST(sum(index_bytes) AS BIGINT) AS index_bytes,
         CAST(sum(toast_bytes) AS BIGINT) AS toast_bytes,
         CAST(sum(total_bytes) AS BIGINT) AS total_bytes
  FROM chunks GROUP BY node_name, hypertable_schema, hypertable_name
)"""

PER_NODE_CTE = """
per_node AS (
  SELECT t.data_node, t.hypertable_schema, t.hypertable_name, s.table_bytes, s.index_bytes, s.toast_bytes, s.total_bytes
  FROM (SELECT hypertable_schema, hypertable_name, unnest(data_nodes) AS data_node FROM hypertables) t
  LEFT JOIN node_sizes s USING (data_node, hypertable_schema, hypertable_name)
)"""

# md5 number of a text: first 8 hex digits as bigint
def md5_num(expr: str, digits: int = 8) -> str:
    return f"('0x' || substr(md5({expr}), 1, {digits}))::BIGINT"


# Names in the test queries that are key words of the database.
QUOTED_WORDS = ("user", "order", "table", "select")


def qident(expr: str) -> str:
    words = ", ".join(f"'{w}'" for w in QUOTED_WORDS)
    return (
        f"CASE WHEN regexp_full_match({expr}, '[a-z_][a-z0-9_]*') AND {expr} NOT IN ({words}) THEN {expr} "
        f"ELSE '\"' || replace({expr}, '\"', '\"\"') || '\"' END"
    )


def size_pretty_sql(b: str) -> str:
    m = f"abs({b})"
    sign = f"CASE WHEN {b} < 0 THEN '-' ELSE '' END"

    def unit(shift: int, name: str) -> str:
        return f"{sign} || CAST((({m} >> {shift}) + 1) >> 1 AS VARCHAR) || ' {name}'"

    return (
        f"CASE WHEN {m} < 10240 THEN CAST({b} AS VARCHAR) || ' bytes' "
        f"WHEN ({m} >> 9) < 20479 THEN {unit(9, 'kB')} "
        f"WHEN ({m} >> 19) < 20479 THEN {unit(19, 'MB')} "
        f"WHEN ({m} >> 29) < 20479 THEN {unit(29, 'GB')} "
        f"WHEN ({m} >> 39) < 20479 THEN {unit(39, 'TB')} "
        f"ELSE {unit(49, 'PB')} END"
    )


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def chunks_over(src: str, name: str) -> str:
    """The chunk CTE over another samples relation."""
    return CHUNKS_CTE.replace("chunks AS (", f"{name} AS (", 1).replace("FROM samples GROUP BY", f"FROM {src} GROUP BY")


BASE = with_ctes(SAMPLES_CTE, CHUNKS_CTE)
CATALOG = with_ctes(SAMPLES_CTE, CHUNKS_CTE, HYPERTABLES_CTE, NODE_SIZES_CTE, PER_NODE_CTE)

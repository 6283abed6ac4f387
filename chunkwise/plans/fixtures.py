"""Catalogs and parameters that the registered queries and the tests run with.

Where the database would be asked for its catalog, these derive one from the
samples by fixed md5 rules (FIXTURES.md), so that every table present in the data
gets settings. The operators take such catalogs as DataFrames from anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_SCHEMA
from ..functions.scalar import md5_int

SETTING_COLUMNS = ["series_id", "node", "ts", "value", "labels"]


def _h(name: Column) -> Column:
    return md5_int(name, 8)


def compression_settings(hypertables: DataFrame) -> DataFrame:
    """``compression_settings`` rows for every hypertable (FIXTURES.md section 3).

    Per table h = md5 number of the table name:
    h % 7 = 0 -> no rows; segment-by: series_id at 1 + h % 2, node at 2 - h % 2
    (absent when h % 3 = 0); order-by: ts at 1, value at 2 (absent when
    h % 5 = 0), direction and null order from bits 1..4 of h; labels neither.
    """
    h = _h(F.col("hypertable_name"))
    cols = F.array(*[F.lit(c) for c in SETTING_COLUMNS])
    base = (
        hypertables.select("hypertable_schema", "hypertable_name", h.alias("_h"))
        .filter(F.col("_h") % 7 != 0)
        .select("*", F.posexplode(cols).alias("_pos", "attname"))
    )
    a, hh = F.col("attname"), F.col("_h")
    seg = (
        F.when(a == "series_id", 1 + hh % 2)
        .when((a == "node") & (hh % 3 != 0), 2 - hh % 2)
    )
    order = F.when(a == "ts", F.lit(1)).when((a == "value") & (hh % 5 != 0), F.lit(2))
    bit = lambda i: F.shiftright(hh, i) % 2 == 0
    asc = F.when(a == "ts", bit(1)).when(a == "value", bit(3))
    nulls_first = F.when(a == "ts", bit(2)).when(a == "value", bit(4))
    return base.select(
        "hypertable_schema",
        "hypertable_name",
        "attname",
        seg.cast("int").alias("segmentby_column_index"),
        order.cast("int").alias("orderby_column_index"),
        F.when(order.isNotNull(), asc).alias("orderby_asc"),
        F.when(order.isNotNull(), nulls_first).alias("orderby_nullsfirst"),
    )


def compression_state(hypertables: DataFrame, side: str) -> DataFrame:
    """``(hypertable_schema, hypertable_name, compression_state)`` as seen by one node.

    State and presence follow md5(side || name): % 11 = 0 -> table missing on
    this side; otherwise state = 1 unless % 3 = 0.
    """
    h = _h(F.concat(F.lit(side + ":"), F.col("hypertable_name")))
    return hypertables.select(
        "hypertable_schema", "hypertable_name", h.alias("_h")
    ).filter(F.col("_h") % 11 != 0).select(
        "hypertable_schema",
        "hypertable_name",
        F.when(F.col("_h") % 3 == 0, F.lit(0)).otherwise(F.lit(1)).cast("int").alias("compression_state"),
    )


def target_series(series: DataFrame) -> DataFrame:
    """Series that already exist on the target cluster (FIXTURES.md section 2).

    Label sets with user % 3 = 0; their target ids are arbitrary but fixed:
    the first 12 hex digits of md5(labels).
    """
    user = F.get_json_object("labels", "$.user").cast("long")
    return (
        series.filter(user % 3 == 0)
        .select("labels", md5_int(F.col("labels"), 12).alias("series_id"))
        .distinct()
    )


# Inline parameter tables (FIXTURES.md section 3). These are literal
# parameters of the statements, not data.
BLOCK_RULES = [(0, "dn4"), (2, "dn2")]
ALLOW_RULES = ["dn1"]
ATTACHMENTS = [("click", "cold_space"), ("error", "cold_space"), ("signup", "cold_space"), ("nosuch", "cold_space")]
INDEXES = [
    (DEFAULT_SCHEMA, "click", "click_series_id_ts_idx", ["series_id", "ts"]),
    (DEFAULT_SCHEMA, "click", "click_ts_idx", ["ts"]),
    (DEFAULT_SCHEMA, "error", "error_ts_idx", ["ts"]),
]
MIGRATION_METRICS = ["click", "error", "purchase", "signup", "view", "nosuch"]

"""Scalar Column functions (all JVM-side built-ins, no Python UDF)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ntz_lit(value: dt.datetime | str) -> Column:
    """A timestamp_ntz literal, independent of the session time zone."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


# --- F1 size_pretty -------------------------------------------------------
# Fixed values of the database's size formatter: units, the byte limit
# (10 * 1024) and the limit for every larger unit (20 * 1024 - 1); each unit
# keeps one extra bit for half rounding, so the shifts are 9, 19, 29, 39, 49.
_BYTES_LIMIT = 10 * 1024
_UNIT_LIMIT = 20 * 1024 - 1
_UNITS = [("kB", 9), ("MB", 19), ("GB", 29), ("TB", 39)]
_LAST_UNIT = ("PB", 49)


def size_pretty(b: ColumnOrName) -> Column:
    """Human readable byte count, the same text as ``pg_size_pretty(bigint)``."""
    b = _c(b).cast("long")
    mag = F.abs(b)
    sign = F.when(b < 0, F.lit("-")).otherwise(F.lit(""))

    def unit_text(shift: int, name: str) -> Column:
        half = F.shiftright(F.shiftright(mag, shift) + 1, 1)
        return F.concat(sign, half.cast("string"), F.lit(" " + name))

    expr = F.when(mag < _BYTES_LIMIT, F.concat(b.cast("string"), F.lit(" bytes")))
    for name, shift in _UNITS:
        expr = expr.when(F.shiftright(mag, shift) < _UNIT_LIMIT, unit_text(shift, name))
    return expr.otherwise(unit_text(_LAST_UNIT[1], _LAST_UNIT[0]))


# --- F2 qualified_name ------------------------------------------------------
# The database's key words that can't be names without quotes
# (reserved, function or type names, column names).
KEY_WORDS = """
all analyse analyze and any array as asc asymmetric both case cast check collate column constraint create
current_catalog current_date current_role current_time current_timestamp current_user default deferrable desc distinct
do else end except false fetch for foreign from grant group having in initially intersect into lateral leading limit
localtime localtimestamp not null offset on only or order placing primary references returning select session_user some
symmetric system_user table then to trailing true union unique user using variadic when where window with
authorization binary collation concurrently cross current_schema freeze full ilike inner is isnull join left like
natural notnull outer overlaps right similar tablesample verbose
between bigint bit boolean char character coalesce dec decimal exists extract float greatest grouping inout int integer
interval json json_array json_arrayagg json_exists json_object json_objectagg json_query json_scalar json_serialize
json_table json_value least merge_action national nchar none normalize nullif numeric out overlay position precision
real row setof smallint substring time timestamp treat trim values varchar xmlattributes xmlconcat xmlelement xmlexists
xmlforest xmlnamespaces xmlparse xmlpi xmlroot xmlserialize xmltable
""".split()


def quote_ident(name: ColumnOrName) -> Column:
    """Identifier quoting of ``format('%I')``: plain lower-case names that are no key word stay bare."""
    n = _c(name)
    return F.when(n.rlike(r"\A[a-z_][a-z0-9_]*\z") & ~n.isin(*KEY_WORDS), n).otherwise(
        F.concat(F.lit('"'), F.replace(n, F.lit('"'), F.lit('""')), F.lit('"'))
    )


def qualified_name(schema: ColumnOrName, name: ColumnOrName) -> Column:
    return F.concat(quote_ident(schema), F.lit("."), quote_ident(name))


# --- F4 epoch_ms / F5 nan_to_null ---------------------------------------------

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_us(ts: ColumnOrName) -> Column:
    """Microseconds since 1970-01-01 of a UTC ``timestamp_ntz``."""
    col = _c(ts)
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), col.cast("timestamp_ntz"))


def epoch_ms(ts: ColumnOrName) -> Column:
    """Milliseconds since epoch, floored (also before 1970)."""
    us = epoch_us(ts)
    return ((us - F.pmod(us, F.lit(1000))) / 1000).cast("long")


def nan_to_null(v: ColumnOrName) -> Column:
    """NaN, +Infinity and -Infinity become null; other values pass."""
    v = _c(v)
    bad = F.isnan(v) | (v == F.lit(float("inf"))) | (v == F.lit(float("-inf")))
    return F.when(bad, F.lit(None).cast("double")).otherwise(v)


def is_non_finite(v: ColumnOrName) -> Column:
    v = _c(v)
    return v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))


# --- F6 / F11 text ------------------------------------------------------------


def sql_quote(text: ColumnOrName) -> Column:
    """SQL string literal: single quotes doubled, wrapped in quotes."""
    return F.concat(F.lit("'"), F.replace(_c(text), F.lit("'"), F.lit("''")), F.lit("'"))


def double_text(v: ColumnOrName) -> Column:
    """Text of a double as the database prints it (NaN / Infinity spelled out)."""
    v = _c(v)
    return (
        F.when(F.isnan(v), F.lit("NaN"))
        .when(v == F.lit(float("inf")), F.lit("Infinity"))
        .when(v == F.lit(float("-inf")), F.lit("-Infinity"))
        .otherwise(v.cast("string"))
    )


# --- hashing ---------------------------------------------------------------------


def md5_int(text: ColumnOrName, digits: int = 8) -> Column:
    """First ``digits`` hex digits of md5 as a non-negative bigint (<= 15 digits)."""
    if not 1 <= digits <= 15:
        raise ValueError("digits must be in 1..15")
    return F.conv(F.substring(F.md5(_c(text)), 1, digits), 16, 10).cast("long")

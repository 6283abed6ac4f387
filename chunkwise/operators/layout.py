"""Physical layouts whose sort order differs from table to table, in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RECORDS_PER_FILE = 5_000_000  # keeps files near a few hundred MB


TERM = "struct<column:string,asc:boolean,nulls_first:boolean>"


def masked_sort_keys(orders: DataFrame, order: Column, columns: list[str]) -> list[Column]:
    """Sort keys that give every row the order of its own table.

    ``orders`` has one column of arrays of ``TERM``, one array for each table;
    ``order`` is the row's own array. Each distinct (position, term) is one key, null
    for rows whose array has another term there; their number is bounded by the
    columns of the rows, not by the number of tables. Rows of different tables are
    told apart by keys in front of these.
    """
    found = orders.select(F.posexplode(orders.columns[0]).alias("pos", "t")).select("pos", "t.*").distinct()
    unknown = found.where(~F.col("column").isin(columns)).head(1)
    if unknown:
        raise ValueError(f"no such column: {unknown[0]['column']!r}")
    keys = []
    for t in sorted(found.collect()):
        own = F.get(order, F.lit(t["pos"]))
        match = (own["column"] == t["column"]) & (own["asc"] == t["asc"]) & (own["nulls_first"] == t["nulls_first"])
        key = F.when(match, F.col(f"`{t['column']}`"))
        if t["asc"]:
            keys.append(key.asc_nulls_first() if t["nulls_first"] else key.asc_nulls_last())
        else:
            keys.append(key.desc_nulls_first() if t["nulls_first"] else key.desc_nulls_last())
    return keys


def ascending(columns: Column) -> Column:
    """An array of column names as terms, ascending, nulls first."""
    terms = F.transform(columns, lambda c: F.struct(c.alias("column"), F.lit(True).alias("asc"), F.lit(True).alias("nulls_first")))
    return F.coalesce(terms, F.array().cast(f"array<{TERM}>"))

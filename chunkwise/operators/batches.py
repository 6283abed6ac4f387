"""Batching and export records.

Batches bound every ``collect_list`` group by ``size`` rows, so no group ever
holds an unbounded series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import double_text, epoch_ms, nan_to_null, sql_quote
from .series import one_label_set
from .slices import ROWS_PER_SLICE, slice_bounds, slice_number


def _numbered(
    df: DataFrame, key: Sequence[str], order: Sequence[str], size: int, rows_per_slice: int, prepare: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, bool]:
    """``df`` (or ``prepare(df)``, see :func:`slice_bounds`) with ``_slice``, ``_n`` (the row's number in its key, from 0) and, if the rows
    take more than one slice (the second result), the run's ``_start``, ``_end`` and
    ``_total`` (rows of the key before the run, up to its end, in all).

    A run is the part of a key in one slice of (key, order). Runs are counted from the key
    and order columns alone; each count enters the shuffle of the rows as one marker row in
    front of its run, so a running sum numbers the rows where they are: no join, and the
    rows are shuffled once, by (key, slice).
    """
    if size < 1:
        raise ValueError("size must be >= 1")
    if not order:
        raise ValueError("order must name a column")
    key, columns = list(key), list(dict.fromkeys([*key, *order]))
    bounds = slice_bounds(df, columns, rows_per_slice, prepare)
    df = df if prepare is None else prepare(df)
    rows = df.withColumn("_slice", slice_number(df, columns, bounds))
    running = Window.partitionBy(*key, "_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if bounds is None:  # every key is one run that starts at 0
        return rows.withColumn("_n", F.sum(F.lit(1)).over(running.orderBy(*order)) - 1), False
    runs = rows.groupBy(*key, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    of_key = Window.partitionBy(*key)
    upto = of_key.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum("_rows").over(upto)
    markers = runs.select(
        *key, "_slice", (end - F.col("_rows") - 1).alias("_w"), (end - F.col("_rows")).alias("_start"),
        end.alias("_end"), F.sum("_rows").over(of_key).alias("_total"),
    ).withColumn("_row", F.lit(False))
    both = rows.withColumn("_w", F.lit(1).cast("long")).withColumn("_row", F.lit(True)).unionByName(markers, allowMissingColumns=True)
    running = running.orderBy("_row", *order)
    numbered = both.withColumns(
        {"_n": F.sum("_w").over(running), **{c: F.max(c).over(running) for c in ("_start", "_end", "_total")}}
    )
    return numbered.where("_row").drop("_w", "_row"), True


def with_batches(
    df: DataFrame, key: Sequence[str], order: Sequence[str], size: int, out: str = "batch", rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """B1: ``batch = (row_number() over (partition by key order by order) - 1) div size``.

    A huge key spreads over as many tasks as it has slices, however its rows lie in time.
    ``order`` should make the order total: rows that agree in all of it share a slice. Rows
    with a null key form a group like any other, null order values come first.
    """
    numbered, _ = _numbered(df, key, order, size, rows_per_slice)
    return numbered.select(*df.columns, F.floor(F.col("_n") / F.lit(size)).cast("long").alias(out))


def batch_groups(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    size: int,
    rows_per_slice: int = ROWS_PER_SLICE,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(key, batch, rows): each batch's rows as an array of ``order`` structs in that order.
    With ``prepare``, the rows are those of ``prepare(df)`` (see :func:`slice_bounds`).

    Batches that lie inside one run are complete where the rows were sorted. Only the first
    and last batch of a run that was cut from its key go through a second, small shuffle,
    where the parts of neighbouring runs meet: at most ``size`` rows a batch, two a run.
    """
    key = list(key)
    columns = list(dict.fromkeys([*key, *order]))

    def narrow(rows: DataFrame) -> DataFrame:
        return (rows if prepare is None else prepare(rows)).select(*columns)

    numbered, cut = _numbered(df, key, order, size, rows_per_slice, narrow)
    numbered = numbered.withColumn("batch", F.floor(F.col("_n") / F.lit(size)).cast("long"))
    rows = F.array_sort(F.collect_list(F.struct(*order))).alias("rows")
    if not cut:
        return numbered.groupBy(*key, "_slice", "batch").agg(rows).drop("_slice")
    last = F.least((F.col("batch") + 1) * size, F.col("_total"))
    whole = (F.col("batch") * size >= F.col("_start")) & (last <= F.col("_end"))
    inside = numbered.where(whole).groupBy(*key, "_slice", "batch").agg(rows).drop("_slice")
    border = numbered.where(~whole).groupBy(*key, "batch").agg(rows)
    return inside.unionByName(border)


def batch_plan(samples: DataFrame, size: int, key: str = "metric") -> DataFrame:
    """B2: row count and number of batches (files / statements) per metric."""
    return samples.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_batches", F.ceil(F.col("n_rows") / F.lit(size)).cast("long")
    )


def batch_records(samples: DataFrame, series: DataFrame, size: int, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Per (series, batch) the labels and parallel arrays of values and
    millisecond timestamps in time order.

    Labels are joined after grouping, on the much smaller batch table; that
    inner join also drops the batches of series without labels.
    """
    recs = batch_groups(samples, ["series_id"], ["ts", "value"], size, rows_per_slice).select(
        "series_id",
        "batch",
        F.transform("rows", lambda r: nan_to_null(r["value"])).alias("values"),
        F.transform("rows", lambda r: epoch_ms(r["ts"])).alias("timestamps"),
    )
    return recs.join(one_label_set(series), "series_id")


def json_lines(records: DataFrame) -> DataFrame:
    """One JSON object per record: ``{"metric": {labels}, "values": [...],
    "timestamps": [...]}`` with NaN / Infinity as null and integer ms."""
    body = F.struct(
        F.from_json("labels", "map<string,string>").alias("metric"),
        F.col("values"),
        F.col("timestamps"),
    )
    return records.withColumn("line", F.to_json(body))


def sql_tuple(ts: Column, value: Column, series_id: Column) -> Column:
    """``(TIMESTAMPTZ '<ts>+00', '<value>', '<id>')`` text of one row (UTC)."""
    return F.concat(
        F.lit("(TIMESTAMPTZ "),
        sql_quote(F.concat(ts.cast("string"), F.lit("+00"))),
        F.lit(", "),
        sql_quote(double_text(value)),
        F.lit(", "),
        sql_quote(series_id.cast("string")),
        F.lit(")"),
    )


def insert_opening(schema: str, metric: Column) -> Column:
    """What a statement for the metric's table starts with."""
    return F.concat(F.lit("INSERT INTO " + schema + '."'), F.replace(metric, F.lit('"'), F.lit('""')), F.lit('" values '))


def insert_statements(
    rows: DataFrame,
    size: int,
    schema: str,
    id_col: str = "new_series_id",
    rows_per_slice: int = ROWS_PER_SLICE,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """S9 body: ``INSERT INTO schema."metric" values (...), (...);`` per (metric, batch)
    of at most ``size`` rows, tuples in time order. With ``prepare``, of ``prepare(rows)``
    (see :func:`slice_bounds`)."""
    grouped = batch_groups(rows, ["metric"], ["ts", "value", id_col], size, rows_per_slice, prepare)
    stmt = F.concat(
        insert_opening(schema, F.col("metric")),
        F.array_join(F.transform("rows", lambda r: sql_tuple(r["ts"], r["value"], r[id_col])), ", "), F.lit(";"),
    )
    return grouped.select("metric", "batch", F.size("rows").cast("long").alias("n"), stmt.alias("statement"))

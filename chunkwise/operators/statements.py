"""Written INSERT statements read back and compared with their source.

A statement is an opening, tuples joined by ``, `` and a ``;``. The tuples are cut out by a
pattern that knows quoted texts with doubled quotes, so a bracket or comma inside a text
isn't taken for a border, and a statement that isn't its parts put together has something
else in it. Rows meet as an order-free checksum of parsed values: per metric one row, combined
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import insert_opening

_TEXT = "'([^']*+(?:''[^']*+)*+)'"
_TUPLE = rf"\(TIMESTAMPTZ {_TEXT}, {_TEXT}, {_TEXT}\)"
_BETWEEN = ", "
_ZONE = "+00"


def _tuples(statement: Column) -> Column:
    """The tuple texts of a statement, in order."""
    return F.regexp_extract_all(statement, F.lit(_TUPLE), F.lit(0))


def _with_texts(tuples: DataFrame) -> DataFrame:
    """The three quoted texts of each tuple ``_t`` as ``_1``, ``_2``, ``_3``, null without one.

    A tuple is known to match the pattern, so one cut at every quote into seven parts has no
    doubled quotes, and its texts are parts of it; only others are matched again, by text.
    """
    cut = tuples.withColumn("_cut", F.split("_t", "'"))

    def text(n: int) -> Column:
        quoted = F.replace(F.regexp_extract("_t", _TUPLE, n), F.lit("''"), F.lit("'"))
        return F.when(F.size("_cut") == 7, F.get("_cut", F.lit(2 * n - 1))).otherwise(quoted)

    return cut.withColumns({f"_{n}": text(n) for n in (1, 2, 3)}).drop("_cut")


def _parsed() -> list[Column]:
    """``ts, value, new_series_id`` of a tuple's texts; null where the text is none."""
    stamp = F.col("_1")
    ts = F.when(F.endswith(stamp, F.lit(_ZONE)), F.substr(stamp, F.lit(1), F.length(stamp) - len(_ZONE)).try_cast("timestamp_ntz"))
    return [ts.alias("ts"), F.col("_2").try_cast("double").alias("value"), F.col("_3").try_cast("long").alias("new_series_id")]


def statement_rows(lines: DataFrame) -> DataFrame:
    """(metric, ts, value, new_series_id): one row per tuple of the statements in ``lines``
    (value, metric), as :func:`chunkwise.sources.sinks.read_text` gives them."""
    tuples = lines.select("metric", F.explode(_tuples(F.col("value"))).alias("_t"))
    return _with_texts(tuples).select("metric", *_parsed())


def rows_checksum(ts: Column, value: Column, series_id: Column, counted: Column | None = None) -> Column:
    """An order-free digest of rows (aggregate), of the ``counted`` ones if given: two hashes
    of each row's time, value and id, whose 16-bit parts are added up (as longs, which hold
    the sums of 2^47 rows). Equal rows count as often as they occur; every NaN is the same
    value. Null for no rows."""
    row = [ts.cast("timestamp_ntz"), value.cast("double"), series_id.cast("long"), value.isNull()]
    parts = [F.shiftrightunsigned(h, at).bitwiseAND(0xFFFF).cast("long") for h, bits in ((F.xxhash64(*row), 64), (F.hash(*row), 32)) for at in range(0, bits, 16)]
    sums = [F.sum(p if counted is None else F.when(counted, p)).cast("string") for p in parts]
    return F.concat(sums[0], *[x for s in sums[1:] for x in (F.lit(","), s)])


def statement_tally(lines: DataFrame, schema: str) -> DataFrame:
    """Per metric of the written ``lines`` (value, metric): ``rows_out`` tuples,
    ``n_statements``, ``n_damaged`` statements that aren't their opening, tuples and end and
    nothing else, and the rows' ``checksum``.

    The statements' counts ride on each statement's first tuple (or on a row of their own, if
    it has none), so one pass over the lines and one aggregate give all of it.
    """
    cut = lines.select("metric", "value", _tuples(F.col("value")).alias("_ts"))
    put_together = F.concat(insert_opening(schema, F.col("metric")), F.array_join("_ts", _BETWEEN), F.lit(";"))
    whole = (F.size("_ts") > 0) & (F.col("value") == put_together)
    each = cut.select("metric", F.coalesce(whole, F.lit(False)).alias("_whole"), F.posexplode_outer("_ts").alias("_i", "_t"))
    first = F.coalesce(F.col("_i"), F.lit(0)) == 0
    rows = _with_texts(each).select("metric", "_whole", first.alias("_first"), F.col("_t").isNotNull().alias("_row"), *_parsed())
    return rows.groupBy("metric").agg(
        F.count(F.when(F.col("_row"), 1)).alias("rows_out"),
        F.count(F.when(F.col("_first"), 1)).alias("n_statements"),
        F.count(F.when(F.col("_first") & ~F.col("_whole"), 1)).alias("n_damaged"),
        rows_checksum(F.col("ts"), F.col("value"), F.col("new_series_id"), F.col("_row")).alias("checksum"),
    )

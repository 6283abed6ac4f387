"""Compression policy (G1-G6): compare two nodes' lists, collect order-by and
segment-by rules per table, and apply the rules as a physical layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import quote_ident
from .layout import MAX_RECORDS_PER_FILE, TERM, ascending, masked_sort_keys

KEY = ["hypertable_schema", "hypertable_name"]
NO_TERMS = f"array<{TERM}>"


def compressed_tables(states: DataFrame, schema: str, limit: int | None = None) -> DataFrame:
    """G1: tables of a schema whose compression state is truthy (non-zero)."""
    out = states.filter((F.col("hypertable_schema") == schema) & (F.col("compression_state") != 0)).select(*KEY)
    if limit is not None:
        out = out.orderBy(*KEY).limit(limit)
    return out


def policy_drift(left: DataFrame, right: DataFrame) -> DataFrame:
    """The two nodes' compression states side by side with a status:
    ``same``, ``differs``, ``missing_left`` or ``missing_right``."""
    l_ = left.select(*KEY, F.col("compression_state").alias("state_left"), F.lit(True).alias("_l"))
    r_ = right.select(*KEY, F.col("compression_state").alias("state_right"), F.lit(True).alias("_r"))
    j = l_.join(r_, KEY, "full_outer")
    status = (
        F.when(F.col("_l").isNull(), F.lit("missing_left"))
        .when(F.col("_r").isNull(), F.lit("missing_right"))
        .when(F.col("state_left").eqNullSafe(F.col("state_right")), F.lit("same"))
        .otherwise(F.lit("differs"))
    )
    return j.select(*KEY, "state_left", "state_right", status.alias("status"))


def orderby_term(attname, asc, nulls_first):
    """One order-by term; the default null order of each direction is left out:
    ``c``, ``c NULLS FIRST``, ``c DESC``, ``c DESC NULLS LAST``."""
    return (
        F.when(asc & ~nulls_first, attname)
        .when(asc & nulls_first, F.concat(attname, F.lit(" NULLS FIRST")))
        .when(~asc & nulls_first, F.concat(attname, F.lit(" DESC")))
        .otherwise(F.concat(attname, F.lit(" DESC NULLS LAST")))
    )


def orderby_rules(settings: DataFrame) -> DataFrame:
    """Ordered order-by terms per table (one aggregation for all tables), as structs
    (``orderby_terms``) and as text (``orderby``)."""
    s = settings.filter(F.col("orderby_column_index").isNotNull())
    term = F.struct(
        F.col("orderby_column_index").alias("i"),
        F.col("attname").alias("column"),
        F.coalesce("orderby_asc", F.lit(True)).alias("asc"),
        F.coalesce("orderby_nullsfirst", F.lit(False)).alias("nulls_first"),
    )
    grouped = s.groupBy(*KEY).agg(F.array_sort(F.collect_list(term)).alias("_t"))
    terms = F.transform("_t", lambda x: F.struct(x["column"].alias("column"), x["asc"].alias("asc"), x["nulls_first"].alias("nulls_first")))
    text = F.transform("_t", lambda x: orderby_term(x["column"], x["asc"], x["nulls_first"]))
    return grouped.select(*KEY, text.alias("orderby"), terms.alias("orderby_terms"))


def segmentby_rules(settings: DataFrame) -> DataFrame:
    """Ordered list of segment-by columns per table."""
    s = settings.filter(F.col("segmentby_column_index").isNotNull())
    return s.groupBy(*KEY).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col("segmentby_column_index").alias("i"), F.col("attname").alias("a")))),
            lambda x: x["a"],
        ).alias("segmentby")
    )


def compression_rules(tables: DataFrame, settings: DataFrame) -> DataFrame:
    """G3 + G4 for every listed table; empty arrays when it has no settings."""
    empty = F.array().cast("array<string>")
    return (
        tables.select(*KEY)
        .join(orderby_rules(settings), KEY, "left")
        .join(segmentby_rules(settings), KEY, "left")
        .select(
            *KEY,
            F.coalesce("orderby", empty).alias("orderby"),
            F.coalesce("segmentby", empty).alias("segmentby"),
            F.coalesce("orderby_terms", F.array().cast(NO_TERMS)).alias("orderby_terms"),
        )
    )


def compression_ddl(rules: DataFrame) -> DataFrame:
    """One ALTER TABLE text per table that sets its compression from the rules (column
    names quoted where they have to be); options without columns are left out."""

    def listed(terms, render):
        return F.array_join(F.transform(terms, render), ", ")

    # single quotes inside the option's text are doubled
    option = lambda name, text: F.when(text != "", F.concat(F.lit(f"timescaledb.{name} = '"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'")))
    segment = listed("segmentby", quote_ident)
    order = listed("orderby_terms", lambda t: orderby_term(quote_ident(t["column"]), t["asc"], t["nulls_first"]))
    options = F.concat_ws(", ", F.lit("timescaledb.compress"), option("compress_segmentby", segment), option("compress_orderby", order))
    target = F.concat(quote_ident("hypertable_schema"), F.lit("."), quote_ident("hypertable_name"))
    return rules.select(*KEY, F.concat(F.lit("ALTER TABLE "), target, F.lit(" SET ("), options, F.lit(");")).alias("statement"))


def apply_layout(samples: DataFrame, rules: DataFrame, path: str, compression: str = "zstd") -> DataFrame:
    """Write each ruled table clustered by its segment-by columns and sorted
    by its order-by terms (one folder per metric, dynamic overwrite).

    ``rules``: hypertable_name, segmentby, orderby_terms; best a written table, whose
    size decides how it is joined. All tables are written in one pass: rows are
    range-partitioned on (metric, segment-by, order-by), so a large segment is split
    over tasks, and sorted within partitions. Returns the written rows read back.
    """
    spark = samples.sparkSession
    own = rules.select(F.col("hypertable_name").alias("metric"), F.concat(ascending(F.col("segmentby")), "orderby_terms").alias("_order"))
    keys = masked_sort_keys(own.select("_order"), F.col("_order"), samples.columns)
    nparts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = samples.join(own, "metric")
    out = rows.repartitionByRange(nparts, "metric", *keys).sortWithinPartitions("metric", *keys).select(samples.columns)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy("metric")
        .parquet(path)
    )
    return spark.read.schema(samples.schema).parquet(path)

"""Sizes, distribution over data nodes and chunk placement.

All inputs here are catalog-sized (one row per chunk, per table or per
(node, table)); the number of rows does not grow with the sample count.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import qualified_name, size_pretty
from .numbering import key_ordered_ids

KEY = ["hypertable_schema", "hypertable_name"]


def hypertable_sizes(chunks: DataFrame, ordered: bool = True) -> DataFrame:
    """Bytes per hypertable plus pretty text, largest first."""
    out = chunks.groupBy(*KEY).agg(F.sum("total_bytes").cast("long").alias("total_bytes"))
    out = out.withColumn("size_pretty", size_pretty(F.col("total_bytes")))
    return out.orderBy(F.col("total_bytes").desc_nulls_last(), *KEY) if ordered else out


SIZE_COLUMNS = ["table_bytes", "index_bytes", "toast_bytes", "total_bytes"]


def node_sizes(chunks: DataFrame) -> DataFrame:
    """Bytes (table, index, toast, total) and chunk count per (node, table):
    what the per-node info function reports."""
    return chunks.groupBy(F.col("node_name").alias("data_node"), *KEY).agg(
        *[F.sum(c).cast("long").alias(c) for c in SIZE_COLUMNS],
        F.count(F.lit(1)).alias("num_chunks"),
    )


def catalog_from_node_sizes(sizes: DataFrame) -> DataFrame:
    """The hypertable catalog rebuilt from :func:`node_sizes` (catalog-sized input),
    so a report needing both reads the samples once.

    Rows are unique per (node, table), so ``collect_list`` equals
    ``collect_set`` here; unlike the set it is not duplicate-insensitive, which
    keeps the optimizer from re-deriving this aggregate from the raw scan (a
    second read of the samples) instead of reusing the per-node exchange.
    """
    return sizes.groupBy(*KEY).agg(
        F.array_sort(F.collect_list("data_node")).alias("data_nodes"),
        F.sum("num_chunks").cast("long").alias("num_chunks"),
    )


def node_hypertables(hypertables: DataFrame, sizes: DataFrame) -> DataFrame:
    """D3: one row per (node listed for a table, table) with that node's bytes.

    ``explode`` drops tables whose node list is null or empty, like unnest.
    A listed node without data keeps its row with null bytes.
    """
    pairs = hypertables.select(*KEY, F.explode("data_nodes").alias("data_node"))
    size_cols = [c for c in SIZE_COLUMNS if c in sizes.columns]
    return pairs.join(sizes, ["data_node", *KEY], "left").select("data_node", *KEY, *size_cols)


def node_distribution(per_node: DataFrame, ordered: bool = True) -> DataFrame:
    """Per (node, table) bytes, the table's max over nodes and the most loaded
    node in its own column (every tied node is marked; null bytes never match)."""
    w = Window.partitionBy(*KEY)
    out = per_node.withColumn("max_total_bytes_dn", F.max("total_bytes").over(w)).withColumn(
        "highest_loaded_dn",
        F.when(F.col("total_bytes") == F.col("max_total_bytes_dn"), F.col("data_node")),
    )
    if ordered:
        out = out.orderBy(F.col("max_total_bytes_dn").desc_nulls_last(), *KEY, "data_node")
    return out


def running_max(per_node: DataFrame) -> DataFrame:
    """Max over the table's nodes ordered by bytes descending (default RANGE frame)."""
    w = Window.partitionBy(*KEY).orderBy(F.col("total_bytes").desc())
    return per_node.withColumn("running_max", F.max("total_bytes").over(w))


# --- block / allow -------------------------------------------------------------


def numbered_tables(hypertables: DataFrame) -> DataFrame:
    """Tables numbered 1..n by qualified name, without a single-task sort."""
    named = hypertables.select(*KEY, qualified_name(F.col("hypertable_schema"), F.col("hypertable_name")).alias("qualified_name"))
    return key_ordered_ids(named, "qualified_name", "num", start=1)


def _rules_array(rules: Sequence[tuple[int, str]]):
    return F.array(*[F.named_struct(F.lit("n"), F.lit(int(n)), F.lit("dn"), F.lit(str(dn))) for n, dn in rules])


def block_plan(hypertables: DataFrame, rules: Sequence[tuple[int, str]]) -> DataFrame:
    """Every (rule node, table) whose rule number differs from the table
    number gets action ``block``; number 0 never matches, so it means all tables.

    The rules are literal parameters, so they are inlined as an array literal and
    exploded per table: no join, no broadcast. An empty rule list gives no rows.
    """
    cols = ["dn", "qualified_name", "hypertable_schema", "hypertable_name", "num", "action"]
    if not rules:
        return numbered_tables(hypertables).select(
            F.lit(None).cast("string").alias("dn"), "qualified_name", *KEY, "num", F.lit("block").alias("action")
        ).filter(F.lit(False))
    t = numbered_tables(hypertables)
    return (
        t.select("*", F.explode(_rules_array(rules)).alias("r"))
        .filter(F.col("r.n") != F.col("num"))
        .select(F.col("r.dn").alias("dn"), "qualified_name", *KEY, "num", F.lit("block").alias("action"))
        .select(*cols)
    )


def allow_plan(hypertables: DataFrame, nodes: Iterable[str]) -> DataFrame:
    """Lifts the block for whole nodes: action ``allow`` for every table."""
    nodes = list(nodes)
    t = hypertables.select(*KEY, qualified_name(F.col("hypertable_schema"), F.col("hypertable_name")).alias("qualified_name"))
    arr = F.array(*[F.lit(n) for n in nodes]) if nodes else F.array().cast("array<string>")
    return t.select(F.explode(arr).alias("dn"), "qualified_name", *KEY, F.lit("allow").alias("action"))


def effective_placement(hypertables: DataFrame, *actions: DataFrame) -> DataFrame:
    """Ordered block/allow action sets -> allowed node array per table.

    The last action per (node, table) wins (``max_by`` over the action's
    position); nodes whose last action is ``block`` leave the table's list.
    """
    tagged = None
    for seq, a in enumerate(actions):
        part = a.select("dn", *KEY, "action", F.lit(seq).alias("seq"))
        tagged = part if tagged is None else tagged.unionByName(part)
    last = tagged.groupBy("dn", *KEY).agg(F.max_by("action", "seq").alias("last_action"))
    pairs = hypertables.select(*KEY, F.explode_outer("data_nodes").alias("dn"))
    joined = pairs.join(last, ["dn", *KEY], "left")
    keep = F.col("dn").isNotNull() & (F.col("last_action").isNull() | (F.col("last_action") != "block"))
    return joined.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.when(keep, F.col("dn")))).alias("allowed_nodes"))

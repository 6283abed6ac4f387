"""Connected components by contraction, on tables of any size.

Every step is a join or an aggregation, and its result a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.config import materialize


def roots(parents: DataFrame) -> DataFrame:
    """``parents``: (node, parent), one row per node, parent < node. Returns (node, root)
    of the same nodes, by pointer doubling."""
    current = materialize(parents.select("node", F.col("parent").alias("root")), "roots")
    while True:
        above = current.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        step = current.join(above, "root", "left").select("node", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved"))
        step = materialize(step, "roots")
        current = step.select("node", "root")
        if not step.where("moved").head(1):
            return current


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: (a, b). Returns (node, root) for every node that isn't its component's
    smallest: each root hooks onto its smallest neighbour root, chains are shortened
    and the edges contracted, until none is left."""
    spark = edges.sparkSession
    edges = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    found = spark.createDataFrame([], "node bigint, root bigint")
    while edges.head(1):
        hooked = roots(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent")))
        ends = {c: hooked.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in "ab"}
        joined = edges.join(ends["a"], "a", "left").join(ends["b"], "b", "left")
        joined = joined.select(F.coalesce("a_root", "a").alias("x"), F.coalesce("b_root", "b").alias("y")).where("x <> y")
        edges = materialize(joined.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        higher = hooked.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        found = found.join(higher, "root", "left").select("node", F.coalesce("higher", "root").alias("root")).unionAll(hooked)
        found = materialize(found, "components")
    return found

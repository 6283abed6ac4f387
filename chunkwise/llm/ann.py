"""Approximate nearest neighbours by cross-polytope hashing (operator 10).

A table rotates unit vectors with three rounds of random signs and a fast
Hadamard transform and puts each into the cell of its nearest signed axis. A
query looks into the cells whose axes are nearest to it, ``SHARE`` of all cells in
each of ``tables`` tables; what it meets there is reranked by the exact inner product
of the original vectors, in double precision.

A cell knows directions only, but a long vector is near at a wide angle too. So
vectors are filed in bands of length (a factor of two each), every query searches
every band, and a band may be searched in all its cells. Which ones are is measured:
the true neighbours of a sample of queries are found by comparing them with all
vectors, and the bands that lose most for their size are searched whole until the
sample vouches for ``LEAST_RECALL`` (Wilson's lower bound, two standard errors).
All cells of one table hold every vector once, so a band searched whole costs as
much as half of the cells in two tables.

In Spark a cell of a table is a key. A cell with more than ``block_rows`` vectors
is dealt over several blocks by the hash of the vector's id, and a query goes to
every block of its cells, so that no cell has to fit into one task and none is
cut short. Each block gives a query's best ``k``; a vector that several tables
found counts once; the best of them is the result.

Recall depends on how much nearer the neighbours are than the other vectors. On
vectors without structure (the nearest of 50,000 at an inner product of 0.4) only
a wide search finds them: see the README for recall against the share of vectors
reranked, and ``recall`` for the measurement.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, nor do rows with a null id; vectors of different length
never meet; of rows that share an id a query gets the best, once, and rows that share
a query id are answered as one query; a query never
finds rows with its own id; ties go to the smaller id. A query whose probed cells
hold fewer than ``k`` candidates is asked again in all cells, so that it gets
``k``, or all if there are fewer. The number of rows decides nothing by itself;
only a caller that sets ``exact_rows`` has dimensions of at most so many rows
searched in all cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chunkwise.config import materialize

VECTOR = "vec_id bigint, dim int, vector binary, band int"
SHARE, LEAST_RECALL, SAMPLE = 0.5, 0.95, 200
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def clean_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows that take part, their vectors as little-endian doubles."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, data, bands = [], [], [], []
            for key, vector in zip(batch.column("vec_id").to_pylist(), batch.column("vector"), strict=True):
                values = vector.values
                if key is None or values is None or not len(values) or values.null_count:
                    continue
                v = values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(v).all() or not v.any():
                    continue
                ids.append(key)
                dims.append(len(v))
                data.append(v.astype("<f8").tobytes())
                most = np.abs(v).max()
                bands.append(round(float(np.log2(np.linalg.norm(v / most)) + np.log2(most))))  # unit vectors lie inside a band
            arrays = [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(data, pa.binary()), pa.array(bands, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "dim", "vector", "band"])

    return rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("vector")).mapInArrow(clean, VECTOR)


def rotated(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Three rounds of random signs and a Hadamard transform; columns padded to a power of two."""
    size = 1 << max(1, (x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), size))
    y[:, : x.shape[1]] = x
    rng = np.random.default_rng([seed, table, size])
    for _ in range(3):
        y = y * rng.choice((-1.0, 1.0), size)
        step = 1
        while step < size:
            pairs = y.reshape(len(y), -1, 2, step)
            y = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(len(y), size)
            step *= 2
        y /= np.sqrt(size)
    return y


def nearest_axes(y: np.ndarray, probes: int) -> np.ndarray:
    """The numbers of the ``probes`` signed axes nearest to each row, nearest first: 2 * axis + (1 if negative)."""
    both = np.stack([y, -y], axis=2).reshape(len(y), -1)
    return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def cells_in(dim: int) -> int:
    """How many cells a table of vectors of this length has."""
    return 2 << max(1, (dim - 1).bit_length())


def cells_of(tables: int, probes: dict[int, int] | int, seed: int) -> Column:
    """array<struct<tbl, cell, place>>: the ``probes`` (by dimension) nearest cells of the row's
    vector in every table; place 0 is the nearest."""

    @F.arrow_udf("array<struct<tbl:int,cell:int,place:int>>")
    def cells(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for dims, vectors in batches:
            out: list = [None] * len(dims)
            dim = dims.to_numpy(zero_copy_only=False)
            for d in np.unique(dim):
                rows = np.flatnonzero(dim == d)
                x = np.stack([np.frombuffer(vectors[int(i)].as_buffer(), "<f8") for i in rows])
                x = x / np.abs(x).max(axis=1, keepdims=True)
                found = [nearest_axes(rotated(x, t, seed), probes if isinstance(probes, int) else probes[int(d)]) for t in range(tables)]
                for k, i in enumerate(rows):
                    out[i] = [{"tbl": t, "cell": int(c), "place": p} for t in range(tables) for p, c in enumerate(found[t][k])]
            yield pa.array(out, pa.list_(pa.struct([("tbl", pa.int32()), ("cell", pa.int32()), ("place", pa.int32())])))

    return cells("dim", "vector")


def best_of_block(k: int):
    """Exact rerank in one block of one cell; the block's vectors are at most a few thousand."""

    def best(key: tuple, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not queries.num_rows or not vectors.num_rows:
            return FOUND.empty_table()
        vec_id = vectors.column("vec_id").to_numpy()
        order = np.argsort(vec_id, kind="stable")
        vec_id = vec_id[order]
        data = b"".join(vectors.column("vector").to_pylist())
        v = np.frombuffer(data, "<f8").reshape(len(vec_id), -1)[order]
        out = []
        for batch in queries.to_batches(max_chunksize=256):
            query_id = batch.column("vec_id").to_numpy(zero_copy_only=False)
            q = np.frombuffer(b"".join(batch.column("vector").to_pylist()), "<f8").reshape(len(query_id), -1)
            score = exact_products(q, v)
            score[query_id[:, None] == vec_id[None, :]] = -np.inf
            n = min(k, len(vec_id))
            # everything that ties with the n-th best stays until the ids decide
            edge = -np.partition(-score, n - 1, axis=1)[:, n - 1]
            row, col = np.nonzero((score >= edge[:, None]) & (score > -np.inf))
            rank = np.lexsort((vec_id[col], -score[row, col], row))
            row, col = row[rank], col[rank]
            first = np.searchsorted(row, np.arange(len(query_id)))
            keep = np.arange(len(row)) - first[row] < n
            out.append(pa.table([pa.array(query_id[row[keep]]), pa.array(vec_id[col[keep]]), pa.array(score[row[keep], col[keep]])], schema=FOUND))
        return pa.concat_tables(out)

    return best


def exact_products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products whose value doesn't depend on what else is in the block."""
    return np.einsum("qd,vd->qv", q, v, optimize=False)


def _met(asked: DataFrame, filed: DataFrame, held: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of each query in the cells that it asks.
    ``asked``: (dim, tbl, cell, place, vec_id, vector); ``filed``: (dim, band, tbl, cell, vec_id,
    vector); ``held``: of each cell in each band its blocks, and how many places ask it."""
    held = held.where("probes > 0")
    cell = ["dim", "band", "tbl", "cell"]
    filed = filed.join(F.broadcast(held.drop("probes")), cell).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    asked = asked.join(F.broadcast(held), ["dim", "tbl", "cell"]).where("place < probes")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key = [*cell, "block"]
    left, right = (x.select(*key, "vec_id", "vector").groupBy(*key) for x in (asked, filed))
    found = left.cogroup(right).applyInArrow(best_of_block(k), "query_id bigint, vec_id bigint, score double")
    return _best(found, k)


def _best(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def vouched(missed: int, pairs: int) -> float:
    """Wilson's lower bound, at two standard errors, of the recall of a sample."""
    p, z2 = 1 - missed / pairs, 4.0
    return (p + z2 / (2 * pairs) - 2 * np.sqrt(p * (1 - p) / pairs + z2 / (4 * pairs * pairs))) / (1 + z2 / pairs)


def bands_searched_whole(reach: dict[int, dict[int, int]], sizes: dict[int, int], base: int, least: float) -> set[int]:
    """``reach``: band -> place of a neighbour's cell -> how many; ``sizes``: band -> its vectors.
    The bands that have to be searched whole so that the sample vouches for ``least``."""
    pairs = sum(sum(c.values()) for c in reach.values())
    missed = {b: sum(n for place, n in c.items() if place >= base) for b, c in reach.items()}
    if not pairs:
        return set()
    if vouched(0, pairs) < least:  # too few neighbours to tell
        return set(sizes)
    whole, left = set(), sum(missed.values())
    for b in sorted(missed, key=lambda b: (-missed[b] / sizes[b], b)):
        if vouched(left, pairs) >= least:
            break
        whole.add(b)
        left -= missed[b]
    return whole


def _reach(index: DataFrame, is_query: Column, k: int, tables: int, seed: int, every: dict[int, int]) -> dict[int, dict[int, dict[int, int]]]:
    """dim -> band -> place -> how many true neighbours of the sample lie in a cell that
    is, in the better table, at that place in the query's order."""
    true = materialize(_exact(index, is_query, k, SAMPLE), "sample_neighbours").select("query_id", "vec_id")
    asked = index.where(is_query).select("dim", F.col("vec_id").alias("query_id"), "vector").join(F.broadcast(true.select("query_id").distinct()), "query_id")
    seen = asked.withColumn("c", F.explode(cells_of(tables, every, seed))).select("dim", "query_id", "c.tbl", "c.cell", "c.place")
    lie = index.join(F.broadcast(true), "vec_id").withColumn("c", F.explode(cells_of(tables, 1, seed))).select("dim", "band", "query_id", "vec_id", "c.tbl", "c.cell")
    pairs = lie.join(seen, ["dim", "query_id", "tbl", "cell"]).groupBy("dim", "band", "query_id", "vec_id").agg(F.min("place").alias("place"))
    out: dict[int, dict[int, dict[int, int]]] = {}
    for r in pairs.groupBy("dim", "band", "place").agg(F.count("*").alias("n")).collect():  # bands times cells at most
        out.setdefault(r["dim"], {}).setdefault(r["band"], {})[r["place"]] = r["n"]
    return out


def search(
    rows: DataFrame,
    is_query: Column,
    k: int = 20,
    tables: int = 2,
    probes: int | None = None,
    block_rows: int = 4000,
    exact_rows: int = 0,
    seed: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``is_query``: a condition on vec_id. Per query its ``k`` nearest found: query_id, rank, vec_id, score.
    A caller that sets ``probes`` gets so many cells in each table, without a check of recall."""
    index = materialize(clean_vectors(rows, id_col, vector_col), "vectors")
    sizes: dict[int, dict[int, int]] = {}
    for r in index.groupBy("dim", "band").agg(F.count("*").alias("n")).collect():
        sizes.setdefault(r["dim"], {})[r["band"]] = r["n"]
    every = {d: cells_in(d) for d in sizes}
    base = {d: min(c, probes or int(np.ceil(SHARE * c))) for d, c in every.items()}
    reach = _reach(index, is_query, k, tables, seed, every) if probes is None else {}
    plan = []
    for d, bands in sizes.items():
        whole = set(bands) if sum(bands.values()) <= exact_rows else bands_searched_whole(reach.get(d, {}), bands, base[d], LEAST_RECALL)
        # a table holds every vector once, so all cells of one table are an exact search
        plan += [(d, b, t, (every[d] if t == 0 else 0) if b in whole else base[d]) for b in bands for t in range(tables)]
    plan = rows.sparkSession.createDataFrame(plan, "dim int, band int, tbl int, probes int")
    filed = index.withColumn("c", F.explode(cells_of(tables, 1, seed))).select("dim", "band", "c.tbl", "c.cell", "vec_id", "vector")
    queries = index.where(is_query).select(*[F.col(c).alias(c) for c in ("dim", "vec_id", "vector")])

    def asking(part: DataFrame, tables: int) -> DataFrame:
        return part.withColumn("c", F.explode(cells_of(tables, every, seed))).select("dim", "c.tbl", "c.cell", "c.place", "vec_id", "vector")

    held = filed.groupBy("dim", "band", "tbl", "cell").agg(F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("blocks"))
    held = materialize(held.join(F.broadcast(plan), ["dim", "band", "tbl"]), "cells")  # a row for each cell of each band
    found = materialize(_met(asking(queries, tables), filed, held, k), "neighbours")
    full = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = materialize(queries.join(full, "vec_id", "left_anti").select(queries.columns), "short_queries")
    if not short.head(1):
        return found
    filed = filed.where("tbl = 0").join(F.broadcast(short.select("dim").distinct()), "dim", "left_semi")
    widest = held.withColumn("probes", F.when(F.col("tbl") == 0, F.lit(max(every.values()))).otherwise(0))
    again = _met(asking(short, 1), filed, widest, k)
    return found.join(full.withColumnRenamed("vec_id", "query_id"), "query_id", "left_semi").select(again.columns).unionAll(again)


def _exact(index: DataFrame, is_query: Column, k: int, sample: int) -> DataFrame:
    """query_id, rank, vec_id, score: the true neighbours of at most ``sample`` queries of
    each dimension, from all vectors. The sample is what every task keeps."""
    order = Window.partitionBy("dim").orderBy(F.xxhash64("vec_id"), "vec_id", "vector")
    asked = index.where(is_query).select("dim", "vec_id", "vector").withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample)
    by_dim: dict[int, list] = {}
    for r in asked.collect():
        by_dim.setdefault(r["dim"], []).append((r["vec_id"], bytes(r["vector"])))
    nearest = best_of_block(k)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for d in np.unique(dims):
                vectors = pa.Table.from_batches([batch.take(pa.array(np.flatnonzero(dims == d)))])
                ids, data = zip(*by_dim.get(int(d), ()), strict=True) if int(d) in by_dim else ((), ())
                queries = pa.table({"vec_id": pa.array(ids, pa.int64()), "vector": pa.array(data, pa.binary())})
                yield from nearest((), queries, vectors).to_batches()

    return _best(index.select("dim", "vec_id", "vector").mapInArrow(compare, "query_id bigint, vec_id bigint, score double"), k)


def recall(found: DataFrame, rows: DataFrame, is_query: Column, k: int = 20, sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """The share of the true neighbours, of at most ``sample`` queries of each dimension, that
    ``found`` has; a vector as near as the last true one counts too. 1.0 without queries."""
    true = materialize(_exact(clean_vectors(rows, id_col, vector_col), is_query, k, sample), "true_neighbours")
    last = true.groupBy("query_id").agg(F.min("score").alias("edge"), F.count("*").alias("wanted"))
    right = found.join(last, "query_id").where(F.col("score") >= F.col("edge")).groupBy("query_id").agg(F.count("*").alias("n"))
    r = last.join(right, "query_id", "left").agg(F.sum(F.least(F.coalesce("n", F.lit(0)), "wanted")).alias("n"), F.sum("wanted").alias("wanted")).first()
    return r["n"] / r["wanted"] if r["wanted"] else 1.0

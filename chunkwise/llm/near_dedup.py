"""Near-duplicate documents by MinHash and an LSH forest (operator 6).

*Sets.* A document's words are runs of characters other than ASCII white space,
with A-Z lower-cased; its set holds its shingles of ``shingle`` words, as 64-bit
hashes. A document with fewer words has one element, its whole sequence; one
without words has none and is linked with nothing. Documents with equal sets
become one node.

*Forest.* A node's signature is 128 minima. Each of 32 trees reads it in an order
of its own, starting with four values that no other tree starts with. Nodes that
agree in the first four form a region of that tree; where a region holds more than
``REGION`` nodes it is cut at the first 8, 16, ... values until none does (adaptive
depth); nodes that agree in all 128 are chained. Two documents at the least
similarity of 0.8 share no region of depth 4 with a probability of 5e-8. At depth 8,
where a tree's second four values are the next tree's first, it would be 1.1e-2; so
regions that were cut are completed from depth 4.

*Links.* Inside a region every node is compared with the others by signature; its
best predecessor (in order of node number) among those with an estimate of at
least ``LEAST_ESTIMATE`` (five standard errors under 0.8) is its candidate. The
candidates of all trees give one link per node at most, checked on the full
sets. What that leaves apart is completed in the regions of depth 4 that
hold several components: nodes outside a region's largest component ask all its nodes.
A region is dealt into cells of bounded nodes and elements so that each asking node meets
each other node in one of them. There a pair that is similar by estimate marks its two
nodes, in the first tree that brings it together; the full sets of a cell's marked nodes
are then compared with each other where they meet, and of the links found a spanning
forest comes out. So no pair that shares a region of depth 4 is left out, while neither
copies of one text nor the members of a loose group are ever expanded into rows or lists
of pairs: a cell gives as many rows as it has nodes, at most.

*Components* are found by contraction (``components``).

Defined results: a null text counts as one without words; rows that share an id
and a text share a result; ``component_id`` is the smallest id reachable, null
only if every id in the component is null; an empty table gives an empty result.
Extra columns of the input are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise.config import materialize

from .common import clean_after, drop_ids, give_back, in_buckets, resident
from .components import connected_components, roots

HASHES, TREES, FIRST_DEPTH = 128, 32, 4
REGION = 512
BLOCK = 512
BLOCK_ELEMENTS = 1_000_000
LEAST_ESTIMATE = 0.62
_MIX = np.uint64(0x9E3779B97F4A7C15)
_seeds = np.random.default_rng(20240101).integers(1, 1 << 63, size=(2, HASHES), dtype=np.uint64)
_XOR, _ODD = _seeds[0], _seeds[1] | np.uint64(1)


def words_of(text: str) -> list[bytes]:
    # bytes know ASCII alone: lower() changes A-Z and split() cuts at \x20 and \x09-\x0D
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str, shingle: int) -> np.ndarray:
    """The distinct shingles as sorted 64-bit hashes."""
    words = words_of(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    span = min(shingle, len(words))
    rolled = codes[: len(codes) - span + 1] + np.uint64(span)  # a short text's one element is no shingle
    for k in range(1, span):
        rolled = (rolled ^ (rolled >> np.uint64(31))) * _MIX + codes[k : len(codes) - span + 1 + k]
    rolled ^= rolled >> np.uint64(32)
    rolled *= np.uint64(0xD6E8FEB86659FD93)
    rolled ^= rolled >> np.uint64(29)
    return np.unique(rolled)


def signature(elements: np.ndarray) -> np.ndarray:
    """The 128 minima, 16 bits of each."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(elements), 1024):
        part = elements[k : k + 1024, None] ^ _XOR
        part *= _ODD
        low = np.minimum(low, part.min(axis=0))
    return (low >> np.uint64(8)).astype(np.uint16)  # from the middle: the top bits of minima are zero


def _key(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def sketch(text: Column, shingle: int) -> Column:
    """struct(n, key, sig) of the set; key and sig are null for an empty one."""

    @F.arrow_udf("struct<n:bigint,key:binary,sig:binary>")
    def make(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        resident("near_dedup", dict)  # nothing is kept here, nor what came before
        for batch in clean_after(batches):
            sizes, keys, sigs = [], [], []
            for value in batch:
                elements = shingle_set(value.as_py() or "", shingle)
                sizes.append(len(elements))
                keys.append(_key(elements) if len(elements) else None)
                sigs.append(signature(elements).tobytes() if len(elements) else None)
            yield pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], ["n", "key", "sig"])

    return make(F.coalesce(text, F.lit("")))


def _lists(sets: list[np.ndarray]) -> pa.Array:
    offsets = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *sets])))


def keyed_set(text: Column, shingle: int) -> Column:
    """struct(key, elements) of the set, in full."""

    @F.arrow_udf("struct<key:binary,elements:array<bigint>>")
    def make(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in clean_after(batches):
            sets = [shingle_set(value.as_py() or "", shingle) for value in batch]
            keys = pa.array([_key(elements) for elements in sets], pa.binary())
            yield pa.StructArray.from_arrays([keys, _lists([elements.astype(np.int64) for elements in sets])], ["key", "elements"])

    return make(F.coalesce(text, F.lit("")))


def set_of_key(text: Column, key: Column, shingle: int) -> Column:
    """The elements of the set, in full; empty if its key isn't ``key``. Needs a column from
    each side of a join, so it is computed for the joined rows alone."""

    @F.arrow_udf("array<bigint>")
    def make(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, keys in clean_after(batches):
            sets = [shingle_set(value.as_py() or "", shingle) for value in texts]
            yield _lists([(e if _key(e) == k else e[:0]).astype(np.int64) for e, k in zip(sets, keys.to_pylist(), strict=True)])

    return make(F.coalesce(text, F.lit("")), key)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, HASHES)


def _region_hashes(sig: pa.Array, trees: np.ndarray, depth: int) -> np.ndarray:
    """For each node (a row) and each of its ``trees`` the hash of the first ``depth`` values."""
    values = _matrix(sig).astype(np.uint64)
    h = trees.astype(np.uint64) + np.uint64(depth << 8)
    for k in range(depth):
        h = (h ^ (h >> np.uint64(29))) * _MIX + np.take_along_axis(values, (trees * FIRST_DEPTH + k) % HASHES, axis=1)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h.astype(np.int64)


def regions(depth: int) -> Column:
    """array<struct<tree, region>>: for each tree the hash of the first ``depth`` values of ``sig``."""

    @F.arrow_udf("array<struct<tree:int,region:bigint>>")
    def make(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in clean_after(batches):
            trees = np.tile(np.arange(TREES), (len(batch), 1))
            rows = pa.StructArray.from_arrays([pa.array(trees.ravel(), pa.int32()), pa.array(_region_hashes(batch, trees, depth).ravel())], ["tree", "region"])
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * TREES, pa.int32()), rows)

    return make("sig")


def region_of_tree(depth: int) -> Column:
    """The region of ``sig`` in the one tree of the row."""

    @F.arrow_udf("bigint")
    def make(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for sig, tree in clean_after(batches):
            yield pa.array(_region_hashes(sig, tree.to_numpy(zero_copy_only=False).astype(np.int64)[:, None], depth).ravel())

    return make("sig", "tree")


def forest(nodes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells (cell, nid) of 2 to REGION nodes, chains (nid, pred) of equal signatures,
    first (cell, tree, nid, size): the regions of depth FIRST_DEPTH, cut or not)."""

    def counted(rows: DataFrame, name: str) -> DataFrame:
        # counted apart and joined back: a region of very many nodes is split over tasks
        sizes = materialize(rows.groupBy("region").agg(F.count("*").alias("size")).where("size > 1"), f"{name}_sizes")
        return materialize(rows.join(sizes, "region"), name)

    depth = FIRST_DEPTH
    rows = nodes.select("nid", F.explode(regions(depth)).alias("r")).select("nid", "r.tree", "r.region")
    level = counted(rows, "regions")
    first = level
    cells = [level.where(F.col("size") <= REGION)]
    chains = level.limit(0).select("nid", F.lit(0).cast("bigint").alias("pred"))
    while level.where(F.col("size") > REGION).head(1):
        large = level.where(F.col("size") > REGION)
        if depth == HASHES:
            same = large.where("tree = 0")
            least = materialize(same.groupBy("region").agg(F.min("nid").alias("pred")), "first_nodes")
            chains = same.join(least, "region").where("nid <> pred").select("nid", "pred")
            break
        depth *= 2
        # only the nodes of large regions move, and with their signature alone
        deeper = large.select("nid", "tree").join(in_buckets(nodes.select("nid", "sig"), "nid", large), "nid")
        level = counted(materialize(deeper.select("nid", "tree", region_of_tree(depth).alias("region")), "deeper"), "regions")
        cells.append(level.where(F.col("size") <= REGION))
    every = cells[0]
    for c in cells[1:]:
        every = every.unionAll(c)
    name = F.col("region").alias("cell")
    return every.select(name, "nid"), chains, first.select(name, "tree", "nid", "size")


def _estimates(sig: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i))
    for k in range(0, len(i), 50_000):
        part = slice(k, k + 50_000)
        out[part] = (sig[i[part]] == sig[j[part]]).mean(axis=1)
    return out


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches of rows sorted by cell, cut at the borders of cells; no cell is large."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        cell = rows.column("cell").to_numpy()
        border = int(np.searchsorted(cell, cell[-1]))  # sorted, so the last cell starts here
        rest = rows.slice(border)
        if border:
            yield rows.slice(0, border)
    if rest is not None:
        yield rest


def _pairs_in_cells(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), i before j, of the rows of each cell, a bounded number at a time."""
    cell = rows.column("cell").to_numpy()
    begin = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    sizes = np.diff(np.append(begin, len(cell)))
    rank = np.arange(len(cell)) - np.repeat(begin, sizes)  # row j has ``rank[j]`` predecessors
    ends = np.cumsum(rank)
    start = 0
    while start < len(cell):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + 500_000)))
        j = np.repeat(np.arange(start, stop), rank[start:stop])
        first = np.repeat(np.arange(start, stop) - rank[start:stop], rank[start:stop])
        offset = np.arange(len(j)) - np.repeat(np.cumsum(rank[start:stop]) - rank[start:stop], rank[start:stop])
        yield first + offset, j
        start = stop


def best_predecessors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, nid, sig) sorted by cell and nid -> (nid, pred, estimate): the best
    predecessor of a node in each cell; pred is null for a node that only is one."""
    for rows in _whole_cells(batches):
        nid, sig = rows.column("nid").to_numpy(), _matrix(rows.column("sig").combine_chunks())
        for i, j in _pairs_in_cells(rows):
            estimate = _estimates(sig, i, j)
            good = estimate >= LEAST_ESTIMATE
            i, j, estimate = i[good], j[good], estimate[good]
            order = np.lexsort((i, -estimate, j))
            i2, j2, e2 = i[order], j[order], estimate[order]
            first = np.append(True, j2[1:] != j2[:-1]) if len(j2) else np.zeros(0, dtype=bool)
            alone = np.unique(i)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([nid[j2[first]], nid[alone]])),
                    pa.array(np.concatenate([nid[i2[first]], np.zeros(len(alone), dtype=np.int64)]), mask=np.append(np.zeros(first.sum(), bool), np.ones(len(alone), bool))),
                    pa.array(np.concatenate([e2[first], np.zeros(len(alone))])),
                ],
                names=["nid", "pred", "estimate"],
            )


def _tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``work``, with the memory of the Python worker given back after the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run


def dealt(rooted: DataFrame) -> DataFrame:
    """Rows (cell, tree, nid, n, root) -> (cell, tree, nid, root, member, asks), for cells of
    several components. A cell becomes a grid: its nodes are dealt into parts, those that
    ask (outside its largest component) into parts too, and each pair of parts is a cell of
    about BLOCK nodes or BLOCK_ELEMENTS elements from either side."""
    apart = F.col("root") != F.col("main")
    shares = rooted.groupBy("cell", "root").agg(F.count("*").alias("c"), F.sum("n").alias("e"))
    cells = shares.groupBy("cell").agg(
        F.max(F.struct("c", "root", "e")).alias("m"), F.sum("c").alias("c"), F.sum("e").alias("e"), F.count("*").alias("components")
    ).where("components > 1")

    def parts(nodes: Column, elements: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(nodes / BLOCK), F.ceil(elements / BLOCK_ELEMENTS)).cast("int")

    cells = cells.select("cell", F.col("m.root").alias("main"), parts(F.col("c"), F.col("e")).alias("p"), parts(F.col("c") - F.col("m.c"), F.col("e") - F.col("m.e")).alias("q"))
    number = F.xxhash64("nid")
    rows = rooted.join(cells, "cell").withColumn("asks", apart).withColumn("own", F.pmod(number, "p").cast("int")).withColumn("ask", F.pmod(number, "q").cast("int"))
    held = F.transform(F.sequence(F.lit(0), F.col("q") - 1), lambda k: F.col("own").cast("bigint") * F.col("q") + k)
    asking = F.transform(F.sequence(F.lit(0), F.col("p") - 1), lambda k: k.cast("bigint") * F.col("q") + F.col("ask"))
    rows = rows.withColumn("block", F.explode(F.when(F.col("asks"), F.array_union(held, asking)).otherwise(held)))
    member = F.floor(F.col("block") / F.col("q")) == F.col("own")
    return rows.select(F.xxhash64("cell", "block").alias("cell"), "tree", "nid", "root", member.alias("member"), (F.col("asks") & (F.col("block") % F.col("q") == F.col("ask"))).alias("asks"))


def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, tree, nid, root, member, asks, sig) sorted by cell -> (cell, nid, root): the
    nodes that are similar by estimate to one of another component, of which one asks and the
    other is a member, and that no earlier tree brings together with it."""
    for rows in _whole_cells(batches):
        tree, root, member, asks = (rows.column(c).to_numpy() for c in ("tree", "root", "member", "asks"))
        sig, mark = _matrix(rows.column("sig").combine_chunks()), np.zeros(rows.num_rows, dtype=bool)
        for i, j in _pairs_in_cells(rows):
            meet = (root[i] != root[j]) & ((asks[i] & member[j]) | (asks[j] & member[i]))
            i, j = i[meet], j[meet]
            for k in range(0, len(i), 50_000):
                a, b = i[k : k + 50_000], j[k : k + 50_000]
                equal = sig[a] == sig[b]
                near = equal.mean(axis=1) >= LEAST_ESTIMATE
                a, b, equal = a[near], b[near], equal[near]
                # a tree's first values are those columns that no other tree starts with
                here = equal.reshape(-1, TREES, FIRST_DEPTH).all(axis=2).argmax(axis=1) == tree[a]
                mark[a[here]] = mark[b[here]] = True
        if mark.any():
            yield from rows.select(["cell", "nid", "root"]).filter(pa.array(mark)).combine_chunks().to_batches()


def _spanning(linked: np.ndarray, root: np.ndarray) -> Iterator[tuple[int, int]]:
    """Of the links (a symmetric matrix) between nodes of different components, so many that
    they connect what all of them connect."""
    left, linked = np.ones(len(root), dtype=bool), linked | (root[:, None] == root)
    for start in range(len(root)):
        todo, left[start] = [start] if left[start] else [], False
        while todo:
            i = todo.pop()
            found = np.flatnonzero(linked[i] & left)
            left[found] = False
            todo += found.tolist()
            yield from ((i, j) for j in found.tolist() if root[i] != root[j])


def common_elements(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements any two of the sets share, as a matrix."""
    sizes = np.array([len(e) for e in sets])
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = times[code] > 1
    code, owner = code[shared], owner[shared]
    _, code = np.unique(code, return_inverse=True)
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    both = np.zeros((len(sets), len(sets)))
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, 2048):
        part = slice(*np.searchsorted(code, [low, low + 2048]))
        holds = np.zeros((len(sets), 2048), dtype=np.float32)
        holds[owner[part], code[part] - low] = 1
        both += holds @ holds.T
    return both


def checked(threshold: int):
    """Rows (cell, nid, root, elements) sorted by cell -> (a, b): links between components,
    checked on full sets; of each cell a spanning forest."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_cells(batches):
            cell, nid, root = (rows.column(c).to_numpy() for c in ("cell", "nid", "root"))
            lists = rows.column("elements").combine_chunks()
            values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            begin = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            links = []
            for start, stop in zip(begin, np.append(begin[1:], len(cell)), strict=True):
                sets = [values[offsets[k] : offsets[k + 1]] for k in range(start, stop)]
                sizes, both = np.array([len(e) for e in sets]), common_elements(sets)
                linked = 100 * both >= threshold * (sizes[:, None] + sizes - both)
                links += [(nid[start + i], nid[start + j]) for i, j in _spanning(linked, root[start:stop])]
            a, b = zip(*links, strict=True) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return check


def _similar(threshold: int) -> Column:
    """Whether 100 * intersection >= threshold * union, for the columns of elements x and y."""
    both = F.size(F.array_intersect("x", "y")).cast("bigint")
    return 100 * both >= threshold * (F.size("x") + F.size("y") - both)


class _Sets:
    """Full sets of the nodes that need checking, fetched from the documents once each.
    ``docs``: (code, text); ``nodes`` have the code of one document with their set."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, shingle: int, threshold: int):
        self.docs, self.nodes, self.shingle, self.threshold, self.have = docs, nodes, shingle, threshold, None

    def fetch(self, nids: DataFrame) -> None:
        """``nids``: (nid), distinct."""
        wanted = nids if self.have is None else nids.join(self.have.select("nid"), "nid", "left_anti")
        wanted = materialize(wanted.join(self.nodes.select("nid", "code", "key"), "nid"), "wanted")
        if self.have is not None and not wanted.head(1):
            return
        # texts move, which are smaller than their sets, and sets are made of wanted texts alone
        rows = in_buckets(self.docs, "code", wanted).dropDuplicates(["code"]).join(wanted, "code")
        rows = materialize(rows.select("nid", set_of_key(F.col("text"), F.col("key"), self.shingle).alias("elements")), "sets").where(F.size("elements") > 0)
        self.have = rows if self.have is None else self.have.unionAll(rows)

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Of the pairs (a, b), those whose sets are similar enough; checked on full sets."""
        x = self.have.select(F.col("nid").alias("a"), F.col("elements").alias("x"))
        y = self.have.select(F.col("nid").alias("b"), F.col("elements").alias("y"))
        return materialize(pairs.join(x, "a").join(y, "b").where(_similar(self.threshold)).select("a", "b"), "links")

    def links_in(self, cells: DataFrame) -> DataFrame:
        """``cells``: (cell, nid, root). Links (a, b) between components inside the cells."""
        rows = cells.join(in_buckets(self.have, "nid", cells), "nid").select("cell", "nid", "root", "elements")
        return materialize(_sorted_cells(rows).mapInArrow(_tidy(checked(self.threshold)), "a bigint, b bigint"), "links")


def _sorted_cells(rows: DataFrame) -> DataFrame:
    return rows.repartition("cell").sortWithinPartitions("cell", "nid")


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept. Documents are linked if
    100 * intersection >= threshold * union of their sets."""
    return _components(docs, shingle, threshold, id_col, text_col).drop("key")


def _components(docs: DataFrame, shingle: int, threshold: int, id_col: str, text_col: str) -> DataFrame:
    """``near_duplicates`` with the key of each row's set (null: no words)."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    docs = docs.withColumn("code", F.xxhash64("doc_id", "text"))  # tells rows apart that share an id, or a text
    rows = materialize(docs.select("doc_id", "code", sketch(F.col("text"), shingle).alias("s")).select("doc_id", "code", "s.*"), "sketches")
    nodes = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("rep"), F.min("code").alias("code"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    nodes = materialize(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    sigs = nodes.select("nid", "sig")
    cells, chains, first = forest(nodes)

    found = _sorted_cells(cells.join(sigs, "nid").select("cell", "nid", "sig")).mapInArrow(_tidy(best_predecessors), "nid bigint, pred bigint, estimate double")
    found = found.unionAll(chains.select("nid", "pred", F.lit(1.0).alias("estimate"))).unionAll(chains.select(F.col("pred").alias("nid"), F.lit(None).cast("bigint").alias("pred"), F.lit(0.0).alias("estimate")))
    best = found.groupBy("nid").agg(F.max(F.when(F.col("pred").isNotNull(), F.struct("estimate", (-F.col("pred")).alias("lowest")))).alias("m"))
    best = materialize(best.select("nid", (-F.col("m.lowest")).alias("pred")), "best")
    sets = _Sets(docs.select("code", "text"), nodes, shingle, threshold)
    large = F.col("size") > REGION
    if not best.head(1) and not first.where(large).head(1):
        return _result(rows, nodes, rows.sparkSession.createDataFrame([], "node bigint, root bigint"))
    sets.fetch(best.select("nid"))
    tried = best.where("pred IS NOT NULL").select(F.col("pred").alias("a"), F.col("nid").alias("b"))
    links = sets.linked(tried)
    trees = roots(links.select(F.col("b").alias("node"), F.col("a").alias("parent")))

    # what is left: pairs of one region in different components
    rooted = nodes.select("nid", "n").join(trees.withColumnRenamed("node", "nid"), "nid", "left").withColumn("root", F.coalesce("root", "nid"))
    # in regions that weren't cut the nodes without a candidate are like no other
    left = first.where(~large).join(best.select("nid"), "nid", "left_semi").unionAll(first.where(large).select("nid", "cell", "tree", "size"))
    left = materialize(left.select("cell", "tree", "nid").join(rooted, "nid"), "left")
    open_cells = materialize(dealt(left), "open")
    open_cells = open_cells.join(in_buckets(sigs, "nid", open_cells), "nid").select("cell", "tree", "nid", "root", "member", "asks", "sig")
    near = materialize(_sorted_cells(open_cells).mapInArrow(_tidy(marked), "cell bigint, nid bigint, root bigint"), "marked")
    sets.fetch(near.select("nid").distinct())
    late = sets.links_in(near)
    ends = late
    for c in "ab":
        ends = ends.join(trees.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")), c, "left")
    merged = connected_components(ends.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")))
    up = merged.select(F.col("node").alias("root"), F.col("root").alias("higher"))
    labels = trees.join(up, "root", "left").select("node", F.coalesce("higher", "root").alias("root"))
    labels = labels.unionAll(merged.join(trees.select("node"), "node", "left_anti"))
    return _result(rows, nodes, labels)


def _result(rows: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """``labels``: (node, root) of the nodes that aren't their component's root."""
    named = nodes.select("nid", "key", "rep").join(labels.withColumnRenamed("node", "nid"), "nid", "left").withColumn("root", F.coalesce("root", "nid"))
    named = materialize(named, "named")
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_key = materialize(named.join(smallest, "root").select("key", "component_id"), "components")
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "key").join(by_key, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame, shingle: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, less those that are near a document with a smaller id.
    Where several rows have one id, each is judged by its own text: of those that are near
    each other one stays (that with the least set key), the others as their texts say. Rows
    without an id stay."""
    found = materialize(_components(docs, shingle, threshold, id_col, text_col).where("doc_id IS NOT NULL").select("doc_id", "key", "kept"), "kept")
    dropped = materialize(found.where(~F.col("kept")).select(F.col("doc_id").alias(id_col)).distinct(), "dropped")
    twice = materialize(found.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias(id_col)), "repeated")
    if not twice.head(1):
        return drop_ids(docs, id_col, dropped)
    single = drop_ids(drop_ids(docs, id_col, twice), id_col, dropped)
    # kept rows of one id that have words are all in that id's component
    stay = found.where("kept AND key IS NOT NULL").groupBy("doc_id").agg(F.min("key").alias("key"))
    stay = materialize(stay.select(F.col("doc_id").alias(id_col), F.col("key").alias("__stay")), "staying")
    rows = in_buckets(docs, id_col, twice).join(twice, id_col, "left_semi").withColumn("__set", keyed_set(F.col(text_col), shingle))
    rows = rows.withColumn("__key", F.when(F.size("__set.elements") > 0, F.col("__set.key"))).drop("__set")
    rows = materialize(rows.join(stay, id_col, "left").where(F.col("__key").isNull() | (F.col("__key") == F.col("__stay"))), "repeated_rows")
    one = F.coalesce(F.hex("__key"), F.concat(F.lit("="), F.col(text_col)), F.lit("-"))  # rows without words: equal texts once
    return single.unionByName(rows.withColumn("__one", one).dropDuplicates([id_col, "__one"]).select(docs.columns))

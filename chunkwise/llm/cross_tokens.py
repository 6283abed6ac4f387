"""Alignment of two tokenisers over the same bytes (operator 12).

Tokeniser A is a byte-level byte-pair vocabulary, B a sentencepiece model. Both
encode a space and the text; the bytes of their tokens then join to the same
string, and the byte offsets at which tokens of both end cut them into groups.
An A token and a B token are linked where their byte ranges overlap.

Inside a task all is Arrow: the lists of ids are flattened with their parent
indices, token lengths are summed up segment by segment to end offsets, and one
Acero hash join (full outer) on the document-end key lays the ends of both side
by side. Rows with both sides are the borders of groups; every row, with the
missing side filled from the next token that ends, is one link. ``Table.group_by``
counts the links of each document and pair, and then the documents of each pair;
Spark adds up those partial counts over the corpus.

The second pass meets documents and corpus counts. Pairs held by many documents
(at most ``heads``, a proven bound, chosen by a histogram of the counts) are
looked up in a broadcast table; all others, each held by few documents, go
through an ordinary join. Both give the same numbers; nothing is left out.

A document is handled in parts of about a million characters, cut before a space
between visible characters, where tokens of both end.

Defined results: a null or empty text, and one whose joined A or B bytes differ
from space and text, has no tokens: all numbers are 0 and the digest is empty.
Special strings in a text are plain text. Rows with null or repeated ids are kept
as they are, and each counts as a document; an empty table gives an empty
result. Extra columns of the input are never read.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.config import materialize

from .bpe import WHITE, OffsetTable, read_vocabulary, runs, slices
from .common import WordCache, resident, short_batches

SPACE = "▁"  # how the piece vocabulary writes a space
_OTHER = WHITE.replace(" ", "").replace("\n", "")
# both tokenisers start anew at a space or newline after a visible character
_UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+(?:[{_OTHER}][{WHITE}]*[^{WHITE}]+)*(?:[{WHITE}]+\\Z)?|[{WHITE}]+")
_PART_BYTES = 1 << 21  # about so many bytes of text are aligned at once
_COUNTS_KEPT = 1 << 20  # pairs that a task counts before it hands them on
HEADS = 1 << 20


class PairEncoder:
    """Ids of both tokenisers, unit by unit, and their byte tables."""

    def __init__(self, byte_file: str, piece_file: str, cache_units: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.a.no_padding()
        self.a.no_truncation()
        self.sp = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        spelled = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.bytes_a, self.bytes_b = OffsetTable(read_vocabulary(byte_file)), OffsetTable(spelled)
        self.size_a, self.size_b = len(self.bytes_a.length), len(pieces)
        self.units = WordCache(self._encode, limit=cache_units)
        top = max(self.size_a, self.size_b)
        self.spelled = pa.array([f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(top)])
        self.top = top

    def _encode(self, units: list[str]) -> list[tuple[bytes, bytes]]:
        # a newline is no part of any piece: what follows it is encoded without an added space
        pieces = self.sp.encode(["\n" + u for u in units], num_threads=1)
        first = self.a.encode_batch_fast(units, add_special_tokens=False)
        return [(array("I", e.ids).tobytes(), array("I", p[2:]).tobytes()) for e, p in zip(first, pieces, strict=True)]

    def encode(self, marked: str) -> tuple[bytes, bytes]:
        """Ids of a part that starts with the added space or with a space of the text."""
        found = self.units.values(_UNIT.findall(marked))
        return b"".join([f[0] for f in found]), b"".join([f[1] for f in found])

    def same_bytes(self, marked: str, a: bytes, b: bytes) -> bool:
        want = marked.encode()
        return self.bytes_a.gather(np.frombuffer(a, "<u4")) == want and self.bytes_b.gather(np.frombuffer(b, "<u4")) == want


def encoder(byte_file: str, piece_file: str) -> PairEncoder:
    """The worker's encoder."""
    return resident(("cross_tokens", byte_file, piece_file), lambda: PairEncoder(byte_file, piece_file))


def _list_of(rows: list[bytes]) -> pa.ListArray:
    offsets = np.cumsum([0, *(len(r) // 4 for r in rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), "<i4")))


def ends_of(ids: pa.ListArray, lengths: np.ndarray, name: str) -> pa.Table:
    """One row a token: the key of its document (part) and end offset, and its place."""
    parent, flat = pc.list_parent_indices(ids), pc.list_flatten(ids)
    run = pc.cumulative_sum(pc.take(pa.array(lengths), flat))
    # segmented: less what the lists before have summed up to
    before = pc.take(pa.concat_arrays([pa.array([0], pa.int64()), run]), ids.offsets)
    end = pc.subtract(run, pc.take(before, parent))
    key = pc.add(pc.shift_left(pc.cast(parent, pa.int64()), pa.scalar(32, pa.int64())), end)
    return pa.table({"document_end": key, name: pa.array(np.arange(len(flat), dtype=np.int64))})


class Aligned:
    """Groups and links of some parts of documents."""

    def __init__(self, enc: PairEncoder, a: pa.ListArray, b: pa.ListArray):
        self.enc, self.a, self.b = enc, a, b
        left, right = ends_of(a, enc.bytes_a.length, "a"), ends_of(b, enc.bytes_b.length, "b")
        both = left.join(right, "document_end", join_type="full outer", use_threads=False, coalesce_keys=True)
        both = both.take(pc.sort_indices(both["document_end"])).combine_chunks()
        self.part = (both["document_end"].to_numpy() >> 32) if both.num_rows else np.zeros(0, np.int64)
        self.has_a, self.has_b = (pc.is_valid(both[c]).to_numpy().astype(bool) for c in "ab")
        self.border = self.has_a & self.has_b
        self.group = np.cumsum(self.border) - self.border
        filled = [pc.fill_null_backward(both[c].combine_chunks()) for c in "ab"]
        self.link_a, self.link_b = (pc.take(pc.list_flatten(ids), at).to_numpy().astype(np.int64) for ids, at in zip((a, b), filled, strict=True))

    def per_part(self, rows: np.ndarray) -> np.ndarray:
        return np.bincount(self.part[rows], minlength=len(self.a)) if len(rows) else np.zeros(len(self.a), np.int64)

    def group_texts(self) -> list[str]:
        """Each part's groups as decimal ids, ``a1,a2|b1;a3|b2,b3``."""
        ga, gb = self.group[self.has_a], self.group[self.has_b]
        ids_a, ids_b = (x.flatten().to_numpy() for x in (self.a, self.b))
        off_a, off_b = (x.offsets.to_numpy() for x in (self.a, self.b))
        out, top = np.empty(len(ga) + len(gb), np.int32), self.enc.top
        last_a = np.append(ga[1:] != ga[:-1], True)[: len(ga)]
        last_b = np.append(gb[1:] != gb[:-1], True)[: len(gb)].astype(np.int32) * 2  # "," or ";"
        final = off_b[1:][off_b[1:] > off_b[:-1]] - 1
        last_b[final] = 3
        out[np.arange(len(ga)) + np.searchsorted(gb, ga, "left")] = ids_a + top * last_a
        out[np.arange(len(gb)) + np.searchsorted(ga, gb, "right")] = ids_b + top * last_b
        offsets = pa.array((off_a + off_b).astype(np.int32))
        return pc.binary_join(pa.ListArray.from_arrays(offsets, pc.take(self.enc.spelled, pa.array(out))), "").to_pylist()

    def pair_counts(self, doc_of_part: np.ndarray) -> pa.Table:
        """``key`` (document, A id, B id in one number) and how many links it has."""
        pair = self.link_a * self.enc.size_b + self.link_b
        key = doc_of_part[self.part] * (self.enc.size_a * self.enc.size_b) + pair
        counted = pa.table({"key": key}).group_by("key", use_threads=False).aggregate([([], "count_all")])
        return counted.rename_columns(["times" if c == "count_all" else c for c in counted.column_names]).select(["key", "times"])


def align_texts(enc: PairEncoder, texts: list[str]) -> dict[str, list | np.ndarray | pa.Array]:
    """Columns for a batch of texts: n_a, n_b, n_groups, n_links, groups_sha256, pairs, times."""
    n = len(texts)
    parts, doc_of = [], []  # (ids of A, ids of B) and the document of each part
    for d, text in enumerate(texts):
        if not text:
            continue
        own = [(p, *enc.encode(p)) for p in slices(" " + text)]
        if all(enc.same_bytes(*p) for p in own):
            parts += [(a, b) for _, a, b in own]
            doc_of += [d] * len(own)
    counts = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
    hashes: list[hashlib._Hash | None] = [None] * n
    doc_of_part, tables = np.array(doc_of, np.int64), []
    sizes = np.cumsum([0, *(len(a) + len(b) for a, b in parts)])
    for low, high in runs(sizes, 4 * _PART_BYTES) if parts else ():
        docs = doc_of_part[low:high]
        found = Aligned(enc, _list_of([a for a, _ in parts[low:high]]), _list_of([b for _, b in parts[low:high]]))
        for name, rows in (("n_a", found.has_a), ("n_b", found.has_b), ("n_groups", found.border), ("n_links", np.ones_like(found.border))):
            np.add.at(counts[name], docs, found.per_part(np.flatnonzero(rows)))
        for d, text in zip(docs, found.group_texts(), strict=True):
            if hashes[d] is None:
                hashes[d] = hashlib.sha256()
            else:
                hashes[d].update(b";")
            hashes[d].update(text.encode())
        tables.append(found.pair_counts(docs))
    if tables:
        pairs = pa.concat_tables(tables)
        if len(tables) > 1:  # a document may lie in two of them
            pairs = pairs.group_by("key", use_threads=False).aggregate([("times", "sum")]).rename_columns({"times_sum": "times"})
        pairs = pairs.take(pc.sort_indices(pairs["key"]))
        key, times = pairs["key"].to_numpy(), pairs["times"].to_numpy()
    else:
        key = times = np.zeros(0, np.int64)
    space = enc.size_a * enc.size_b
    offsets = pa.array(np.searchsorted(key, np.arange(n + 1) * space).astype(np.int32))
    pair_type = pa.int32() if space < 2**31 else pa.int64()
    return counts | {
        "groups_sha256": ["" if h is None else h.hexdigest() for h in hashes],
        "pairs": pa.ListArray.from_arrays(offsets, pa.array(key % space).cast(pair_type)),
        "times": pa.ListArray.from_arrays(offsets, pa.array(times).cast(pa.int32())),
    }


def _count_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, n): partial counts of the documents that hold a pair."""

    def merged(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select(["pair", "n"])

    kept: list[pa.Table] = []
    for batch in batches:
        pair = pc.list_flatten(batch.column("pairs"))  # each document holds a pair once
        kept.append(pa.table({"pair": pair, "n": pa.array(np.ones(len(pair), np.int64))}))
        if sum(t.num_rows for t in kept) > 2 * _COUNTS_KEPT:
            kept = [merged(kept)]
            if kept[0].num_rows > _COUNTS_KEPT:
                yield from kept[0].to_batches(max_chunksize=100_000)
                kept = []
    if kept:
        yield from merged(kept).to_batches(max_chunksize=100_000)


def _vocabulary_sizes(byte_file: str, piece_file: str) -> tuple[int, int]:
    import sentencepiece

    return len(read_vocabulary(byte_file)), sentencepiece.SentencePieceProcessor(model_file=piece_file).get_piece_size()


def token_pairs(docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and its linked id
    pairs (``a * size_b + b``, in order) with the number of links of each."""
    size_a, size_b = _vocabulary_sizes(byte_file, piece_file)
    pair_type = "int" if size_a * size_b < 2**31 else "bigint"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def aligned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(byte_file, piece_file)
        for batch in batches:
            columns = align_texts(enc, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **columns})

    schema = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(aligned, f"doc_id {id_type}, {schema}, pairs array<{pair_type}>, times array<int>")


def pair_counts(pairs: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): how many documents hold a pair, and whether no pair of its A id has more."""
    kind = pairs.schema["pairs"].dataType.elementType.simpleString()
    partial = pairs.select("pairs").mapInArrow(_count_documents, f"pair {kind}, n bigint")
    counts = materialize(partial.groupBy("pair").agg(F.sum("n").alias("n")), "pair_counts")
    first = F.floor(F.col("pair") / size_b).cast("int")
    # one row for each id of A's vocabulary at most
    most = counts.groupBy(first.alias("first")).agg(F.max("n").alias("most"))
    marked = counts.withColumn("first", first).join(F.broadcast(most), "first")
    return marked.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _head_threshold(counts: DataFrame, heads: int) -> int:
    """The least count such that at most ``heads`` pairs reach it; from a histogram of few bins."""
    bins = counts.groupBy(F.floor(F.log2("n") * 8).cast("int").alias("bin")).agg(F.count("*").alias("pairs"), F.min("n").alias("least"))
    total, threshold = 0, 1 << 62
    for r in sorted(bins.collect(), key=lambda r: -r["bin"]):
        total += r["pairs"]
        if total > heads:
            break
        threshold = r["least"]
    return threshold


def align(docs: DataFrame, byte_file: str, piece_file: str, heads: int = HEADS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    short_batches(spark)
    _, size_b = _vocabulary_sizes(byte_file, piece_file)
    found = token_pairs(docs, byte_file, piece_file, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    found = materialize(found, "token_pairs")
    counts = materialize(pair_counts(found, size_b), "marked_pairs")
    threshold = _head_threshold(counts, heads)
    top = counts.where(F.col("n") >= threshold).toArrow().sort_by("pair")  # at most ``heads`` rows
    shared = spark.sparkContext.broadcast(tuple(top[c].to_numpy() for c in ("pair", "n", "best")))

    def looked_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counted, best = shared.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy().astype(np.int64)
            offsets, pairs = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().to_numpy()
            at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)

            def summed(values: np.ndarray, offsets: np.ndarray = offsets) -> np.ndarray:
                run = np.append(0, np.cumsum(values))
                return run[offsets[1:]] - run[offsets[:-1]]

            rare = ~known
            left = pa.array(summed(rare).cumsum(dtype=np.int32), pa.int32())
            left = pa.concat_arrays([pa.array([0], pa.int32()), left])
            columns = {c: batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
            columns["n_best"] = summed(np.where(known & best[at], times, 0) if len(keys) else times * 0)
            columns["count_sum"] = summed(np.where(known, counted[at] * times, 0) if len(keys) else times * 0)
            columns["rare"] = pa.ListArray.from_arrays(left, pa.array(pairs[rare]))
            columns["rare_times"] = pa.ListArray.from_arrays(left, pa.array(times[rare]))
            yield pa.RecordBatch.from_pydict(columns)

    types = {f.name: f.dataType.simpleString() for f in found.schema.fields}
    own = ", ".join(f"{c} {types[c]}" for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"))
    met = found.mapInArrow(looked_up, f"{own}, n_best bigint, count_sum bigint, rare {types['pairs']}, rare_times array<bigint>")
    met = materialize(met, "met_pairs")
    links = met.select("row", F.explode(F.arrays_zip("rare", "rare_times")).alias("l")).select("row", F.col("l.rare").alias("pair"), F.col("l.rare_times").alias("times"))
    rest = links.join(counts.where(F.col("n") < threshold), "pair").groupBy("row")
    rest = rest.agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    out = met.join(rest, "row", "left")
    return out.select(
        *("doc_id", "n_a", "n_b", "n_groups", "n_links"),
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )

"""Benchmark decontamination by q-gram lemma filtering and banded alignment (operator 1).

Documents and benchmark items are compared in a plain form: lower case, every run
of characters that are neither letters nor digits one space. An item of ``m``
plain characters occurs in a document if some stretch of it is within
``k = floor(m * error_share)`` edits of the item.

*Filter.* Such a stretch shares at least ``m + 1 - q * (k + 1)`` of the item's
character q-grams, on diagonals (position in the document less position in the
item) at most ``k`` apart. Hits are counted in bands of diagonals, ``2 * (k + 1)``
wide and overlapping by half, so that those of one occurrence share a band; bands
below the bound are dropped. ``q`` is the largest length at most ``max_q`` for
which every item has a bound above 0, so the filter loses no occurrence.

*Verification.* The region of a retained band is aligned with the item by dynamic
programming inside the band, free at both ends of the region. Of overlapping
occurrences of an item the one with the fewest edits, then the leftmost, is kept.

The benchmark is a stated query set: its index is made and broadcast in blocks of
at most ``block_chars`` characters, and every block meets all rows. Whole texts are
read, long ones in overlapping windows.

Items so short that no edit is allowed (under ten characters at a share of 0.1) are
found exactly and only as whole words, except in scripts without spaces.

Defined results: a null text, and items without a letter or digit, match nothing; items with equal text are found
each; equal documents get equal rows; null ids stay null; an empty table on
either side gives an empty result. Extra columns are never read.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise.config import materialize

from .common import clean_after, resident
from .ngrams import code_points

LEAK = "struct<item_id:bigint,start:bigint,end:bigint,edits:int>"
_SPACE = 32
_MARK = 10  # between documents that are searched together; no plain character
_TOKEN = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 20
_FINE_Q = 3
_WINDOW = 1 << 19  # characters hashed at a time
_PAIRS_AT_ONCE = 1 << 20  # pairs of equal q-grams counted at a time
_NO_SPACES = 0x2E80  # scripts without spaces between words start here


@lru_cache(maxsize=1)
def _plain_codes() -> np.ndarray:
    """For every code point the one in its place: lower case, or a space."""
    codes = np.full(sys.maxunicode + 1, _SPACE, dtype=np.uint32)
    for m in _TOKEN.finditer("".join(map(chr, range(sys.maxunicode + 1)))):
        for c in m.group():
            low = c.lower()
            codes[ord(c)] = ord(low) if len(low) == 1 else ord(c)
    return codes


def plain(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The characters of the plain form, and the place in ``text`` of each."""
    codes = _plain_codes()[code_points(text)]
    word = codes != _SPACE
    keep = word.copy()
    keep[1:] |= word[:-1]  # the first space of each run
    places = np.flatnonzero(keep)
    if len(places) and not word[places[0]]:
        places = places[1:]
    if len(places) and not word[places[-1]]:
        places = places[:-1]
    return codes[places], places


def rolling(codes: np.ndarray, q: int) -> np.ndarray:
    """Hash of every q-gram."""
    h = codes[: len(codes) - q + 1].astype(np.uint64)
    for k in range(1, q):
        h = h * _BASE + codes[k : len(codes) - q + 1 + k]
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


def alignment(item: np.ndarray, region: np.ndarray, low: int, high: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best occurrence of ``item`` in ``region`` on the diagonals
    ``low`` to ``high``: fewest edits, then leftmost end, then the longest stretch."""
    width, far = high - low + 1, len(item) + len(region) + 1
    shift = np.arange(width)
    at = low + shift  # column of the current row on each diagonal
    cost = np.where((at >= 0) & (at <= len(region)), 0, far)
    start = np.where(cost == 0, at, 0)
    for i, c in enumerate(item):
        column = at + i  # columns of row i; row i + 1 is one further on the same diagonal
        inside = (column >= 0) & (column < len(region))
        same = np.zeros(width, dtype=bool)
        same[inside] = region[column[inside]] == c
        step = cost + np.where(inside, ~same, far)
        up = np.append(cost[1:] + 1, far)  # the item's character left out: the diagonal to the right
        origin = np.where(up < step, np.append(start[1:], 0), start)
        best = np.minimum(step, up)
        best[(column + 1 < 0) | (column + 1 > len(region))] = far
        # insertions run along the row: a running minimum of cost less position
        reach = best - shift
        running = np.minimum.accumulate(reach)
        source = np.maximum.accumulate(np.where(reach == running, shift, 0))
        cost = np.minimum(best, running + shift)
        start = np.where(cost < best, origin[source], origin)
        cost[(column + 1 < 0) | (column + 1 > len(region))] = far
    k = int(cost.argmin())
    return (int(cost[k]), int(start[k]), int(at[k] + len(item))) if cost[k] < far else None


def at_borders(codes: np.ndarray, start: int, stop: int) -> bool:
    """Whether no word goes on before ``start`` or after ``stop``. Scripts that are written
    without spaces (from U+2E80 on) have no such border: there any place will do."""
    left = start == 0 or codes[start - 1] == _SPACE or max(codes[start - 1], codes[start]) >= _NO_SPACES
    right = stop == len(codes) or codes[stop] == _SPACE or max(codes[stop - 1], codes[stop]) >= _NO_SPACES
    return bool(left and right)


def largest_q(size: int, budget: int, max_q: int) -> int:
    """The longest q-gram length with a positive bound ``size + 1 - q * (budget + 1)``."""
    return min(max_q, size // (budget + 1))


@dataclass
class Index:
    """The q-grams of items of similar length that share one ``q``."""

    ids: list
    items: list[np.ndarray]
    budgets: np.ndarray
    q: int
    grams: np.ndarray  # distinct hashes, ascending
    first: np.ndarray  # of each hash, its first entry in the next two
    item: np.ndarray
    position: np.ndarray
    present: np.ndarray  # of each hash prefix, whether any hash has it

    @classmethod
    def build(cls, ids: list, items: list[np.ndarray], budgets: list[int], q: int) -> Index:
        hashes = [rolling(i, q) for i in items]
        flat = np.concatenate(hashes)
        order = np.argsort(flat, kind="stable")
        owner = np.repeat(np.arange(len(items)), [len(h) for h in hashes])[order]
        position = np.concatenate([np.arange(len(h)) for h in hashes])[order]
        grams, first = np.unique(flat[order], return_index=True)
        present = np.zeros(1 << _TABLE_BITS, dtype=bool)
        present[(grams >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
        return cls(ids, items, np.array(budgets), q, grams, np.append(first, len(flat)), owner, position, present)

    def __post_init__(self):
        self.sizes = np.array([len(i) for i in self.items])
        self.bounds = self.sizes + 1 - self.q * (self.budgets + 1)
        self.reach = int((self.sizes + self.budgets).max())  # no occurrence is longer

    def half_bands(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, count): shared q-grams of the hashes ``h`` by item and half a band of
        diagonals, less those in places with too few of them. A gram that is common in
        text and items makes many pairs; they are counted a bounded number at a time."""
        none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        at = np.flatnonzero(self.present[(h >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.grams, h[at]), len(self.grams) - 1)
        sure = self.grams[place] == h[at]
        at, place = at[sure], place[sure]
        # the first hit of an occurrence has the others within reach
        ahead = np.searchsorted(at, at + self.reach) - np.arange(len(at))
        dense = np.flatnonzero(ahead >= self.bounds.min())
        if not len(dense):
            return none
        mark = np.bincount(dense, minlength=len(at) + 1) - np.bincount(dense + ahead[dense], minlength=len(at) + 1)
        near = np.cumsum(mark)[:-1] > 0
        at, place = at[near], place[near]
        times = self.first[place + 1] - self.first[place]
        ends = np.cumsum(times)
        keys, counts, start = [], [], 0
        while start < len(at):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _PAIRS_AT_ONCE, "right")))
            n = times[start:stop]
            entry = np.arange(n.sum()) + np.repeat(self.first[place[start:stop]] - (np.cumsum(n) - n), n)
            item = self.item[entry]
            diagonal = np.repeat(at[start:stop], n) - self.position[entry]
            # a band is two neighbouring halves, so the half-bands' counts are added
            key, count = np.unique(item.astype(np.int64) << 40 | (diagonal // (self.budgets[item] + 1) + (1 << 30)), return_counts=True)
            keys.append(key)
            counts.append(count)
            start = stop
        if len(keys) == 1:
            return keys[0], counts[0]
        every, place = np.unique(np.concatenate([*keys, none[0]]), return_inverse=True)
        return every, np.bincount(place, weights=np.concatenate([*counts, none[0]]), minlength=len(every)).astype(np.int64)

    def regions(self, h: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, lowest diagonal, highest diagonal) of every band that meets its bound."""
        key, count = self.half_bands(h)
        if not len(key):
            return []
        bands = np.unique(np.concatenate([key, key - 1]))
        total = np.zeros(len(bands), dtype=np.int64)
        total[np.searchsorted(bands, key)] += count
        total[np.searchsorted(bands, key - 1)] += count
        found = []
        for band in bands[total >= self.bounds[np.minimum(bands >> 40, len(self.items) - 1)]]:
            i = int(band >> 40)
            wide = int(self.budgets[i]) + 1
            low = (int(band & ((1 << 40) - 1)) - (1 << 30)) * wide
            found.append((i, low, low + 2 * wide - 1))
        return found

    def occurrence(self, codes: np.ndarray, low: int, high: int, i: int) -> tuple[int, int, int] | None:
        """The best occurrence of item ``i`` on these diagonals, if it keeps to the budget.

        Before the alignment the bound is checked again for short q-grams, exactly: how
        many of the item's positions start one that the text has on a diagonal of the
        band. A diagonal that agrees throughout is the alignment."""
        item, budget = self.items[i], int(self.budgets[i])
        padded = np.full(high - low + len(item), _MARK, dtype=codes.dtype)
        begin, end = max(0, low), min(len(codes), high + len(item))
        if end > begin:
            padded[begin - low : end - low] = codes[begin:end]
        same = np.lib.stride_tricks.sliding_window_view(padded, len(item)) == item
        whole = np.flatnonzero(same.all(axis=1))
        if len(whole):
            places = [low + int(w) for w in whole if budget or at_borders(codes, low + int(w), low + int(w) + len(item))]
            return (0, places[0], places[0] + len(item)) if places else None
        if not budget:
            return None
        q = largest_q(len(item), budget, _FINE_Q)
        runs = same[:, : len(item) - q + 1].copy()
        for k in range(1, q):
            runs &= same[:, k : len(item) - q + 1 + k]
        if int(runs.any(axis=0).sum()) < len(item) + 1 - q * (budget + 1):
            return None
        best = alignment(item, codes, low, high)
        return best if best and best[0] <= budget else None


@dataclass
class Block:
    """The indexes of a part of the benchmark, one for each class of lengths."""

    classes: list[Index]

    @classmethod
    def build(cls, rows: list[tuple[int | None, np.ndarray]], error_share: float, max_q: int) -> Block:
        """``rows``: (item id, plain characters). A class ends where an item is a fifth
        longer than its shortest, or takes another ``q``."""
        classes: list[tuple[int, list]] = []
        for key, item in sorted(rows, key=lambda r: (len(r[1]), r[0] is None, r[0])):
            budget = int(len(item) * error_share)
            q = largest_q(len(item), budget, max_q)
            if not classes or classes[-1][0] != q or len(item) > 1.2 * len(classes[-1][1][0][1]):
                classes.append((q, []))
            classes[-1][1].append((key, item, budget))
        return cls([Index.build(*map(list, zip(*members, strict=True)), q) for q, members in classes])

    def leaks(self, texts: list[str]) -> list[list[dict]]:
        """For each text its occurrences, by start, end and item."""
        out: list[list[dict]] = [[] for _ in texts]
        begin = 0
        while begin < len(texts):
            forms, held = [], 0
            while begin + len(forms) < len(texts) and (not forms or held < _WINDOW):
                forms.append(plain(texts[begin + len(forms)]))
                held += len(forms[-1][0]) + 1
            self._leaks_of(forms, out[begin : begin + len(forms)])
            begin += len(forms)
        return out

    def _leaks_of(self, forms: list[tuple[np.ndarray, np.ndarray]], out: list[list[dict]]) -> None:
        """Several texts are searched as one, with a mark between them that no item has."""
        mark = np.array([_MARK], dtype=np.uint32)
        codes = np.concatenate([part for form, _ in forms for part in (form, mark)])
        starts = np.cumsum([0] + [len(form) + 1 for form, _ in forms])
        found: dict[tuple[int, int, int], set] = {}
        reach = max((c.reach for c in self.classes), default=0)
        for begin in range(0, max(1, len(codes)), _WINDOW):
            part = codes[begin : begin + _WINDOW + 2 * reach]
            hashes = {q: rolling(part, q) for q in {c.q for c in self.classes} if len(part) >= q}
            for n, index in enumerate(self.classes):
                for i, low, high in index.regions(hashes[index.q]) if index.q in hashes else ():
                    low, high = low + begin, high + begin
                    last = min(len(codes), high + index.sizes[i] + int(index.budgets[i]))
                    for d in range(np.searchsorted(starts, max(0, low), side="right") - 1, np.searchsorted(starts, last, side="left")):
                        if d < len(forms):
                            own = forms[d][0]
                            if got := index.occurrence(own, low - int(starts[d]), high - int(starts[d]), i):
                                found.setdefault((d, n, i), set()).add(got)
        for (d, n, i), spans in sorted(found.items()):
            places = forms[d][1]
            kept: list[tuple[int, int]] = []  # in order, not overlapping
            for edits, start, stop in sorted(spans):
                k = bisect_left(kept, (start, stop))
                if (k == 0 or kept[k - 1][1] <= start) and (k == len(kept) or stop <= kept[k][0]):
                    kept.insert(k, (start, stop))
                    out[d].append({"item_id": self.classes[n].ids[i], "start": int(places[start]), "end": int(places[stop - 1]) + 1, "edits": edits})
        for rows in out:
            rows.sort(key=lambda r: (r["start"], r["end"], r["item_id"] is None, r["item_id"]))


def blocks_of(benchmark: DataFrame, error_share: float, max_q: int, block_chars: int, id_col: str, text_col: str) -> Iterator[Block]:
    """The benchmark in blocks, one in memory at a time."""
    rows = benchmark.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    held, chars = [], 0
    for r in rows.toLocalIterator():
        item = plain(r["text"])[0]
        if not len(item):
            continue
        held.append((r["item_id"], item))
        chars += len(item)
        if chars >= block_chars:
            yield Block.build(held, error_share, max_q)
            held, chars = [], 0
    if held:
        yield Block.build(held, error_share, max_q)


def leaks_in(text: Column, block: Broadcast) -> Column:
    """array of the occurrences of the block's items in the text."""

    @F.arrow_udf(f"array<{LEAK}>")
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())])
        resident(("decontamination",), object)  # what another operator kept goes
        for batch in clean_after(batches):
            out = []
            for k in range(0, len(batch), 256):  # a few texts at a time are copied from the batch
                out += block.value.leaks(batch.slice(k, 256).to_pylist())
            yield pa.array(out, pa.list_(kind))

    return search(F.coalesce(text, F.lit("")))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    error_share: float = 0.1,
    max_q: int = 8,
    block_chars: int = 4_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per occurrence: doc_id, item_id, start, end (code points of the document), edits."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    parts, pending = [], None
    for block in blocks_of(benchmark, error_share, max_q, block_chars, item_id_col, item_text_col):
        if pending is not None:  # more than one block: each is searched, stored and given up in turn
            parts.append(materialize(pending[0], "leaks"))
            pending[1].unpersist()
        shared = spark.sparkContext.broadcast(block)
        found = rows.select("doc_id", F.explode(leaks_in(F.col("text"), shared)).alias("leak"))
        pending = found.select("doc_id", "leak.item_id", "leak.start", "leak.end", "leak.edits"), shared
    if pending is None:
        return rows.limit(0).selectExpr("doc_id", "0L AS item_id", "0L AS start", "0L AS end", "0 AS edits")
    return reduce(DataFrame.unionAll, [*parts, pending[0]])


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, all columns, in which no benchmark item occurs."""
    spark = docs.sparkSession
    options = {"error_share": 0.1, "max_q": 8, "block_chars": 4_000_000, **options}
    shared = None
    for block in blocks_of(benchmark, **options, id_col="item_id", text_col="text"):
        if shared is not None:  # more than one block: its survivors are stored before the next
            docs = materialize(docs, "unleaked")
            shared.unpersist()
        shared = spark.sparkContext.broadcast(block)
        docs = docs.where(F.size(leaks_in(docs[text_col], shared)) == 0)
    return docs

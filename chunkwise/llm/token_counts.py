"""Token counts by prefix dynamic programming (operator 9).

For a byte-pair vocabulary the encoding of a text is the one sequence of pieces
in which every piece encodes to itself and every adjacent pair of pieces encodes
to that pair. So the encoding of a prefix of length ``i`` ends in exactly one
piece ``t`` that fits the last piece of the prefix of length ``i - len(t)``, and

    count(i) = count(i - len(t)) + 1.

The table of ``count(i)`` and of each prefix's last piece answers the token
count of every prefix, truncation to a budget and "does it fit" without encoding
again. Whether a pair fits is asked of the library once and remembered.

No piece holds a space after another character, so a text falls into units
(spaces and the word that follows) whose tables are independent: a prefix's
count is the sum of the units before it plus the count inside its own unit.
Units repeat, so each worker keeps the totals of recent ones (bounded).

Defined results: a null text counts as empty; an empty text has 0 tokens; equal
rows give equal rows; an empty table gives an empty result. Extra columns of the
input are never read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordCache, resident

SPACE = "▁"  # how the vocabulary writes a space
_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_PAIRS_KEPT = 400_000
_BATCH_WORDS = 200_000


class PrefixCounter:
    """Exact token counts of all prefixes under one sentencepiece byte-pair model."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(self.sp.get_piece_size())
        self.pieces = {
            self.sp.id_to_piece(i)
            for i in ids
            if not (self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_byte(i) or self.sp.is_unused(i))
        }
        self.reach: dict[str, int] = {}  # last two characters -> length of the longest piece that ends so
        for p in self.pieces:
            self.reach[p[-2:]] = max(len(p), self.reach.get(p[-2:], 0))
        if "\n" in "".join(self.pieces):
            raise ValueError("the vocabulary has pieces with a newline; it can't serve as a barrier")
        self.fits: dict[tuple[str, str], bool] = {}
        self.totals = WordCache(lambda units: [self.unit_counts(u)[-1] for u in units])

    def _encode(self, s: str) -> list[str]:
        # a newline is no part of any piece, so what follows it is encoded on its own
        return self.sp.encode("\n" + s.replace(SPACE, " "), out_type=str)[2:]

    def _fit(self, last: str, piece: str) -> bool:
        """``last``: the piece before, or "" at the start and after a character without a piece."""
        if len(self.fits) >= _PAIRS_KEPT:
            self.fits.clear()
        known = self.fits[(last, piece)] = self._encode(last + piece) == ([last, piece] if last else [piece])
        return known

    def unit_counts(self, unit: str) -> list[int]:
        """``counts[i]``: tokens of the first ``i`` characters of ``unit`` (spaces as ``SPACE``)."""
        pieces, fits, fit, reach = self.pieces, self.fits.get, self._fit, self.reach.get
        counts, last = [0], [""]
        for i in range(1, len(unit) + 1):
            for j in range(max(0, i - reach(unit[max(0, i - 2) : i], 1)), i):
                piece = unit[j:i]
                if piece in pieces and ((known := fits((last[j], piece))) or known is None and fit(last[j], piece)):
                    counts.append(counts[j] + 1)
                    last.append(piece)
                    break
            else:  # no piece has this character: one token for each of its bytes
                counts.append(counts[i - 1] + len(unit[i - 1].encode("utf-8", "surrogatepass")))
                last.append("")
        return counts

    def units(self, text: str) -> list[str]:
        """The independent units of the text, with the space that the library puts in front."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        if SPACE * 2 not in marked and marked[-1] != SPACE:
            return [SPACE + w for w in marked[1:].split(SPACE)]
        return _UNIT.findall(marked)

    def prefix_counts(self, text: str) -> list[int]:
        """``counts[i]``: tokens of ``text[:i]`` for every ``i`` from 0."""
        out, base = [0], 0
        for k, unit in enumerate(self.units(text)):
            counts = self.unit_counts(unit)
            # the first character of the first unit is the added space, part of no prefix
            out.extend(base + c for c in (counts[2:] if k == 0 else counts[1:]))
            base += counts[-1]
        return out

    def longest_prefix(self, text: str, budget: int, units: list[str] | None = None, totals: list[int] | None = None) -> int:
        """Characters of the longest prefix with at most ``budget`` tokens."""
        units = self.units(text) if units is None else units
        ends = list(accumulate(self.totals.values(units) if totals is None else totals))
        k = bisect_right(ends, budget)
        whole = sum(map(len, units[:k]))
        if k == len(units):
            return len(text)
        left = budget - (ends[k - 1] if k else 0)
        inside = max(i for i, c in enumerate(self.unit_counts(units[k])) if c <= left)
        return max(0, whole + inside - 1)  # less the added space


def counter(model_file: str) -> PrefixCounter:
    """The worker's counter."""
    return resident(("token_counts", model_file), lambda: PrefixCounter(model_file))


def token_stats(text: Column, model_file: str, budget: int) -> Column:
    """struct(n_tokens, cut): the token count of the whole text and the length in
    code points of its longest prefix with at most ``budget`` tokens."""

    @F.arrow_udf("struct<n_tokens:bigint,cut:bigint>")
    def stats(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = counter(model_file)
        for batch in batches:
            n_tokens, cuts = [], []
            for value in batch:
                doc = value.as_py() or ""
                units = c.units(doc)
                total, cut, at = 0, -1, 0
                for k in range(0, len(units), _BATCH_WORDS):
                    part = units[k : k + _BATCH_WORDS]
                    totals = c.totals.values(part)
                    size = sum(totals)
                    if cut < 0 and total + size > budget:
                        inside = c.longest_prefix(doc, budget - total, part, totals) if total <= budget else 0
                        cut = at + inside + (1 if at else 0)
                    total += size
                    at += sum(map(len, part)) - (0 if at else 1)
                n_tokens.append(total)
                cuts.append(len(doc) if cut < 0 else cut)
            yield pa.StructArray.from_arrays([pa.array(n_tokens, pa.int64()), pa.array(cuts, pa.int64())], ["n_tokens", "cut"])

    return stats(F.coalesce(text, F.lit("")))


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit, cut (code points that fit the limit)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), token_stats(F.col("text"), model_file, limit).alias("s"))
    return rows.select("doc_id", "n_bytes", "s.n_tokens", (F.col("s.n_tokens") > limit).alias("over_limit"), "s.cut")

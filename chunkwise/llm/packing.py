"""Packing of tokenised documents into fixed windows by minimum bin slack (operator 7).

Each document becomes its token ids and one end id. A document of ``n`` ids is
cut into ``n // capacity`` full pieces, each a sequence of its own, and one
remainder shorter than the window. Only the remainders have to be packed.

The packer sees their histogram: for each length how many there are, at most
``capacity - 1`` numbers at any corpus size. It repeats: take the longest length
left, find by subset-sum dynamic programming the multiset of the other lengths
that fills the window closest to its capacity, and use that multiset as often as
the counts allow. A bitset holds the reachable sums; counts go in by powers of
two, so a length with a million remainders costs twenty shifts; backtracking
over the stored bitsets gives how often each length is used. Every round uses up
at least one length, so there are at most ``capacity - 1`` patterns.

Spark does the rest: it ranks the remainders of each length (in salted blocks,
with block offsets) and joins each rank to the pattern slot that it falls in.

Defined results: a null text counts as empty; an empty document is its end id
alone; repeated rows are packed as often as they occur; rows with a null id are
packed too; an empty table gives an empty result. Extra columns of the input are
never read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chunkwise.config import materialize

from .common import WordCache, resident

PIECE = "struct<start:bigint,length:bigint,ids_crc32:bigint,doc_tokens:bigint,ids:binary>"
_LETTERS = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
_BLOCK_ROWS = 500  # about so many pieces of one length are ranked together
_WORDS_AT_ONCE = 200_000
CACHE_WORDS = 350_000  # words that a worker keeps (twice as many at most), about 100 MB


class WordEncoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes, word by word.

    The vocabulary's pre-tokeniser never crosses a space or a newline, so the
    ids of a text are the ids of its words, joined. Special strings hold no
    space either and stay what the library makes of them. Words of Latin letters,
    with or without marks behind them, go straight to the library's byte-pair
    model, in lower case and with their bytes spelled as the vocabulary spells
    them; all others go through the whole tokeniser.
    """

    def __init__(self, tokenizer_file: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        spell = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0xC0, 0x100) if chr(c).isalpha()]
        self.spelling = str.maketrans({c: spell.pre_tokenize_str(c)[0][0] for c in letters})
        self.words = WordCache(self._encode, limit=cache_words)
        self.marks = WordCache(self._library, limit=1000)

    def _library(self, words: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _encode(self, words: list[str]) -> list[bytes]:
        out, odd, marks, model = {}, [], self.marks, self.tokenizer.model
        for w in words:
            m = _LETTERS.fullmatch(w)
            if m is None:
                odd.append(w)
                continue
            letters, after = m.groups()
            letters = letters.lower()
            ids = array("I", [t.id for t in model.tokenize(letters if letters.isascii() else letters.translate(self.spelling))]).tobytes()
            out[w] = ids + marks.values([after])[0] if after else ids
        for k in range(0, len(odd), 4000):
            out.update(zip(odd[k : k + 4000], self._library(odd[k : k + 4000]), strict=True))
        return [out[w] for w in words]

    def ids(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        return b"".join([b"".join(self.words.values(words[k : k + _WORDS_AT_ONCE])) for k in range(0, len(words), _WORDS_AT_ONCE)])


def encoder(tokenizer_file: str, cache_words: int) -> WordEncoder:
    """The worker's encoder."""
    return resident(("packing", tokenizer_file, cache_words), lambda: WordEncoder(tokenizer_file, cache_words))


def pieces_of(text: Column, tokenizer_file: str, capacity: int, end_id: int, keep_ids: bool, cache_words: int) -> Column:
    """array of the pieces of one document: full windows, then the remainder."""

    @F.arrow_udf(f"array<{PIECE}>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc, end = encoder(tokenizer_file, cache_words), end_id.to_bytes(4, "little")
        for batch in batches:
            offsets, starts, lengths, crcs, totals, ids = [0], [], [], [], [], []
            for value in batch:
                got = enc.ids(value.as_py() or "") + end
                n = len(got) // 4
                for start in range(0, n, capacity):
                    piece = got[4 * start : 4 * (start + capacity)]
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    crcs.append(zlib.crc32(piece))
                    totals.append(n)
                    ids.append(piece if keep_ids else None)
                offsets.append(len(starts))
            columns = [pa.array(c, pa.int64()) for c in (starts, lengths, crcs, totals)] + [pa.array(ids, pa.binary())]
            rows = pa.StructArray.from_arrays(columns, ["start", "length", "ids_crc32", "doc_tokens", "ids"])
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)

    return cut(F.coalesce(text, F.lit("")))


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, with its counts, whose sum is the largest that is at most ``room``."""
    mask = (1 << (room + 1)) - 1
    reach, history = 1, []
    for length in sorted(counts, reverse=True):
        left, power = min(counts[length], room // length), 1
        while left > 0:
            k = min(power, left)
            history.append((length, k, reach))
            reach |= (reach << (k * length)) & mask
            left -= k
            power *= 2
        if reach >> room:
            break
    total, used = reach.bit_length() - 1, {}
    for length, k, before in reversed(history):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + k
            total -= k * length
    return used


def minimum_slack_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (length -> how often in one window) and how many windows use each."""
    left = {n: c for n, c in histogram.items() if c > 0}
    if any(n <= 0 or n > capacity for n in left):
        raise ValueError("lengths must be between 1 and the capacity")
    patterns = []
    while left:
        longest = max(left)
        left[longest] -= 1
        used = fullest({n: c for n, c in left.items() if c and n <= capacity - longest}, capacity - longest)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(left[n] // k for n, k in used.items())
        patterns.append((used, times))
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return patterns


def slot_table(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first_rank, ranks, per_window, first_window, offset): the ranks
    of one length that one pattern takes, and where they lie in its windows."""
    rows, taken, window = [], {}, 0
    for used, times in patterns:
        offset = 0
        for length in sorted(used, reverse=True):
            k = used[length]
            first = taken.get(length, 0)
            rows.append((length, first, k * times, k, window, offset))
            taken[length] = first + k * times
            offset += k * length
        window += times
    return rows


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = 2048,
    end_id: int = 1,
    keep_ids: bool = True,
    cache_words: int = CACHE_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces with doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and,
    unless ``keep_ids`` is off, the ids as little-endian unsigned 32-bit bytes."""
    spark = docs.sparkSession
    cut = docs.select(F.col(id_col).alias("doc_id"), F.explode(pieces_of(F.col(text_col), tokenizer_file, capacity, end_id, keep_ids, cache_words)).alias("p"))
    cut = cut.select("doc_id", "p.*")
    pieces = materialize(cut if keep_ids else cut.drop("ids"), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    sizes = dict(histogram)
    full = histogram.pop(capacity, 0)
    patterns = minimum_slack_patterns(histogram, capacity)
    rows = [(capacity, 0, full, 1, 0, 0)] if full else []
    rows += [(n, first, ranks, k, full + window, offset) for n, first, ranks, k, window, offset in slot_table(patterns)]
    schema = "length bigint, first_rank bigint, ranks bigint, per_window bigint, first_window bigint, slot_offset bigint"
    # grouped by length: one row for each of at most ``capacity`` lengths
    slots = (
        spark.createDataFrame(rows, schema)
        .groupBy("length")
        .agg(F.sort_array(F.collect_list(F.struct("first_rank", "ranks", "per_window", "first_window", "slot_offset"))).alias("slots"))
    )
    blocks = spark.createDataFrame([(n, -(-c // _BLOCK_ROWS)) for n, c in sizes.items()], "length bigint, blocks bigint")
    # a block is fixed by the row's content, so that a task run again deals the same ranks
    pieces = pieces.join(F.broadcast(blocks), "length").withColumn("block", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("blocks")))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.groupBy("length", "block").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    order = Window.partitionBy("length", "block").orderBy("doc_id", "start", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(order) - 1)
    ranked = ranked.join(offsets.select("length", "block", "before"), ["length", "block"]).withColumn("rank", F.col("rank") + F.col("before"))
    ranked = ranked.join(F.broadcast(slots), "length")
    slot = F.expr("element_at(filter(slots, s -> s.first_rank <= rank and rank < s.first_rank + s.ranks), 1)")
    placed = ranked.withColumn("s", slot).withColumn("r", F.col("rank") - F.col("s.first_rank"))
    return placed.select(
        *("doc_id", "start", "length", "ids_crc32", "doc_tokens"),
        (F.col("s.first_window") + F.floor(F.col("r") / F.col("s.per_window"))).cast("bigint").alias("sequence_id"),
        (F.col("s.slot_offset") + F.pmod(F.col("r"), F.col("s.per_window")) * F.col("length")).cast("bigint").alias("offset"),
        *(["ids"] if keep_ids else []),
    )

"""Byte-pair encoding and decoding (operator 13).

Encoding backtracks over longest matches. An Aho-Corasick automaton of all
tokens, run over a word from its end, gives the longest token that starts at
each byte; every shorter token that starts there is a prefix of it and is
reached through a table. The encoder takes the longest token, and the next
shorter one while the token does not fit the token before it; where none is
left it takes back the last token and marks the place as dead. A place is dead
at most once and has a bounded number of tokens, so the work is linear.

Two tokens fit if byte-pair merging of their joined bytes gives these two again.
A sequence whose neighbours all fit is the one that merging gives, so the result
is exact. Whether a pair fits is decided by undoing its merges from the last on
(``TokenTable._fits``) and remembered in a bounded table.

Words come from the vocabulary's own rule (a byte-level pre-tokeniser). No word
goes from a visible character into white space, so a text falls into chunks
(white space and what follows) that are encoded apart; workers keep the ids of
recent chunks. Text with characters above U+024F is cut into words by the
library, since the classes of rare characters depend on its Unicode version.

Decoding looks up each id's place in one string of all tokens' bytes (an offset
table) and gathers the bytes; bytes that are no UTF-8 become U+FFFD.

Defined results: a null text counts as empty; an empty text has no ids and
decodes to the empty string; special strings in a text are single ids, unless
``special`` is off; null and repeated ids of rows are kept; an empty table gives
an empty result. Extra columns of the input are never read. A text is handled in
slices of about a million characters, cut where a chunk starts.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordCache, resident, short_batches

# White space of Unicode, and the word rule of byte-level vocabularies.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_CUT = re.compile(f"[^{WHITE}](?= [^{WHITE}])")
_RARE = re.compile("[\u0250-\U0010ffff]")
_PAIRS_KEPT = 400_000
_SLICE = 1 << 20  # characters of a text that are encoded at once
_AT_ONCE = 1 << 21  # ids that are turned to text at once
CACHE_CHUNKS = 200_000


def slices(text: str, size: int = _SLICE) -> Iterator[str]:
    """The text in parts of about ``size`` characters, each but the first starting with a
    space between visible characters; longer only where there is no such place."""
    at = 0
    while len(text) - at > size:
        m = _CUT.search(text, at + size)
        if m is None:
            break
        yield text[at : m.end()]
        at = m.end()
    yield text[at:] if at else text


def runs(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose lists hold about ``most`` values together, at least one row each."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
        yield low, min(high, n)
        low = high


class OffsetTable:
    """Bytes of tokens by id: one string of all, with each token's place in it."""

    def __init__(self, tokens: list[bytes]):
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def gather(self, ids: np.ndarray) -> bytes:
        """The joined bytes of the tokens."""
        parts = []
        for k in range(0, len(ids), _AT_ONCE):
            part = ids[k : k + _AT_ONCE]
            lengths = self.length[part]
            ends = np.cumsum(lengths)
            places = np.arange(ends[-1]) + np.repeat(self.start[part] - (ends - lengths), lengths)
            parts.append(self.blob[places].tobytes())
        return b"".join(parts)

    def text(self, ids: np.ndarray) -> str:
        return self.gather(ids).decode("utf-8", "replace")


def vocabulary_bytes(data: dict) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary file, added tokens as they are written."""
    # a byte is spelled as itself where it is printable Latin-1, else from U+0100 on in order
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spelled = {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(sorted(set(range(0x100)) - set(own)))}
    vocab, special = data["model"]["vocab"], {t["content"]: t["id"] for t in data["added_tokens"]}
    tokens = [b""] * (1 + max([*vocab.values(), *special.values()]))
    for token, i in vocab.items():
        tokens[i] = bytes(spelled[c] for c in token)
    for token, i in special.items():
        tokens[i] = token.encode()
    return tokens


def _read(tokenizer_file: str) -> dict:
    with open(tokenizer_file, encoding="utf-8") as f:
        return json.load(f)


def read_vocabulary(tokenizer_file: str) -> list[bytes]:
    return vocabulary_bytes(_read(tokenizer_file))


class TokenTable:
    """The vocabulary as bytes, its merges, and the pair-compatibility table."""

    def __init__(self, tokenizer_file: str):
        data = _read(tokenizer_file)
        model, words = data["model"], data["pre_tokenizer"] or {}
        if model["type"] != "BPE" or words.get("type") != "ByteLevel" or words.get("add_prefix_space") or not words.get("use_regex") or data["normalizer"]:
            raise ValueError("not a plain byte-level byte-pair vocabulary")
        if model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
            raise ValueError("the model has options that this encoder doesn't know")
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in data["added_tokens"]):
            raise ValueError("added tokens that take their surroundings aren't supported")
        vocab = model["vocab"]
        self.bytes = vocabulary_bytes(data)
        self.size = len(self.bytes)
        self.rank = [-1] * self.size  # when a token's last merge happens; -1 for single bytes
        self.parts: list[tuple[int, int]] = [(-1, -1)] * self.size
        self.merges: dict[int, int] = {}  # left << 32 | right -> rank
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            made, a, b = vocab[left + right], vocab[left], vocab[right]
            if self.rank[made] >= 0 or max(self.rank[a], self.rank[b]) >= rank:
                raise ValueError("merges must make each token once, after its parts")
            self.rank[made], self.parts[made] = rank, (a, b)
            self.merges[a << 32 | b] = rank
        self.known: dict[int, bool] = {}
        # tokens that merging can't give, whatever the text, take no part
        self.usable = {self.bytes[i]: i for i in vocab.values() if self.rank[i] < 0 or self._fits(*self.parts[i], joined=True)}

    def _fits(self, x: int, y: int, joined: bool = False) -> bool:
        """Whether no merge ever crosses the border of ``x`` and ``y``.

        Undo the merges of both from the last on. At each time one piece ``u`` ends at the
        border and one piece ``v`` starts there; ``u`` lasts until merge ``until_u``, ``v``
        until ``until_v``. A merge of both crosses if its turn comes before those (of equal
        merges the left one comes first). ``joined``: ``x`` and ``y`` are the parts of a token.
        """
        rank, parts, merges = self.rank, self.parts, self.merges
        u, v, until_u, until_v = x, y, 1 << 60, 1 << 60
        while True:
            m = merges.get(u << 32 | v)
            if m is not None and m < until_u and m <= until_v and not (joined and u == x and v == y):
                return False
            ru, rv = rank[u], rank[v]
            if ru < 0 and rv < 0:
                return True
            if ru > rv:
                until_u, u = ru, parts[u][1]
            else:
                until_v, v = rv, parts[v][0]

    def fits(self, x: int, y: int) -> bool:
        key = x << 32 | y
        known = self.known.get(key)
        if known is None:
            if len(self.known) >= _PAIRS_KEPT:
                self.known.clear()
            known = self.known[key] = self._fits(x, y)
        return known


class BytePairCodec:
    """Encoder and decoder of one byte-level vocabulary."""

    def __init__(self, tokenizer_file: str, special: bool = True, cache_chunks: int = CACHE_CHUNKS):
        import ahocorasick
        import regex
        from tokenizers.pre_tokenizers import ByteLevel

        self.table = table = TokenTable(tokenizer_file)
        self.offsets = OffsetTable(table.bytes)
        self.whole = {token.decode("latin-1"): i for token, i in table.usable.items()}
        self.length = self.offsets.length.tolist()
        self.shorter = [-1] * table.size  # the longest token that is a proper prefix
        for token, i in self.whole.items():
            self.shorter[i] = next((self.whole[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in self.whole), -1)
        self.automaton = ahocorasick.Automaton()  # of the tokens read backwards
        for token, i in self.whole.items():
            self.automaton.add_word(token[::-1], i)
        self.automaton.make_automaton()
        self.words = regex.compile(WORD_RULE).findall
        self.library = ByteLevel(add_prefix_space=False, use_regex=True)
        self.splits = re.compile("(" + "|".join(map(re.escape, sorted(table.special, key=len, reverse=True))) + ")") if special and table.special else None
        self.chunks = WordCache(self._encode_chunks, limit=cache_chunks)

    def encode_word(self, word: str) -> list[int]:
        """The ids of one word, its bytes given as Latin-1 characters."""
        found = self.whole.get(word)
        if found is not None:
            return [found]
        n, length, shorter, known, fits = len(word), self.length, self.shorter, self.table.known.get, self.table.fits
        # of the tokens that start at one byte the automaton reports the longest first; it counts from the end
        longest = dict(list(self.automaton.iter(word[::-1]))[::-1])
        dead: set[int] = set()
        ids, at, token, last = [], 0, longest[n - 1], -1
        while at < n:
            while token >= 0:
                end = at + length[token]
                if last < 0 or (fit := known(last << 32 | token)) or fit is None and fits(last, token):
                    if end not in dead:
                        break
                token = shorter[token]
            if token >= 0:
                ids.append(token)
                at, last = end, token
                token = longest[n - 1 - at] if at < n else -1
            else:  # nothing goes on from here after what stands before
                dead.add(at)
                at -= length[last]
                token = shorter[ids.pop()]
                last = ids[-1] if ids else -1
        return ids

    def encode_chunk(self, chunk: str) -> list[int]:
        if _RARE.search(chunk):
            words = [chunk[a:b] for _, (a, b) in self.library.pre_tokenize_str(chunk)]
        else:
            words = self.words(chunk)
        ids: list[int] = []
        for word in words:
            ids += self.encode_word(word if word.isascii() else word.encode().decode("latin-1"))
        return ids

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        return [array("I", self.encode_chunk(c)).tobytes() for c in chunks]

    def _plain(self, text: str) -> bytes:
        return b"".join([b"".join(self.chunks.values(_CHUNK.findall(part))) for part in slices(text)])

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        if self.splits is None:
            return self._plain(text)
        parts = self.splits.split(text)
        return b"".join([array("I", [self.table.special[p]]).tobytes() if k % 2 else self._plain(p) for k, p in enumerate(parts) if p])

    def decode(self, ids: np.ndarray) -> str:
        return self.offsets.text(ids)


def codec(tokenizer_file: str, special: bool = True) -> BytePairCodec:
    """The worker's codec."""
    return resident(("bpe", tokenizer_file, special), lambda: BytePairCodec(tokenizer_file, special))


def offset_table(tokenizer_file: str) -> OffsetTable:
    """The worker's table for decoding: no more than the tokens' bytes."""
    return resident(("bpe bytes", tokenizer_file), lambda: OffsetTable(read_vocabulary(tokenizer_file)))


def _lists(batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and values of a batch of lists of ids."""
    offsets = batch.offsets.to_numpy()
    return offsets - offsets[0], batch.flatten().to_numpy(zero_copy_only=False)


def encode(text: Column, tokenizer_file: str, special: bool = True) -> Column:
    """array<int>: the ids of a text."""

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(tokenizer_file, special)
        for batch in batches:
            rows = [c.encode(value.as_py() or "") for value in batch]
            offsets = np.cumsum([0, *(len(r) // 4 for r in rows)], dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), "<i4")))

    return ids_of(F.coalesce(text, F.lit("")))


def decode(ids: Column, tokenizer_file: str) -> Column:
    """string: the text of an array of ids."""

    @F.arrow_udf("string")
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = offset_table(tokenizer_file)
        for batch in batches:
            offsets, values = _lists(batch)
            yield pa.array([table.text(values[a:b]) for a, b in zip(offsets, offsets[1:], strict=False)], pa.string())

    return text_of(ids)


def ids_digest(ids: Column) -> Column:
    """string: SHA-256 of an array's decimal ids joined by commas."""

    @F.arrow_udf("string")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            offsets, values = _lists(batch)
            out = []
            for low, high in runs(offsets, _AT_ONCE):
                text = pa.array(values[offsets[low] : offsets[high]]).cast(pa.string())
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets[low : high + 1] - offsets[low], pa.int32()), text), ",")
                out.extend(hashlib.sha256(memoryview(x.as_buffer())).hexdigest() for x in joined)
            yield pa.array(out, pa.string())

    return digest(ids)


def encode_documents(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", special: bool = True) -> DataFrame:
    """Per document: doc_id, ids."""
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.select("doc_id", encode(F.col("text"), tokenizer_file, special).alias("ids"))


def decode_documents(encoded: DataFrame, tokenizer_file: str) -> DataFrame:
    """Per document of ``encode_documents``: doc_id, ids, decoded."""
    return encoded.select("doc_id", "ids", decode(F.col("ids"), tokenizer_file).alias("decoded"))

"""Hashed character n-grams of many strings at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_CHARS_AT_ONCE = 1 << 20


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def hashed_ngrams(strings: list[str], sizes: tuple[int, ...], bits: int, salt: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of arrays (index of the string, bucket below ``2 ** bits``), one entry for
    each n-gram of a string between two marks; long inputs come in several pairs."""
    start = 0
    while start < len(strings):
        end, held = start, 0
        while end < len(strings) and (end == start or held + len(strings[end]) + 2 <= _CHARS_AT_ONCE):
            held += len(strings[end]) + 2
            end += 1
        part = strings[start:end]
        codes = code_points("".join([f"\x02{s}\x03" for s in part])).astype(np.uint64)
        owner = np.repeat(np.arange(start, end), [len(s) + 2 for s in part])
        rolled = np.zeros(len(codes), dtype=np.uint64)
        owners, buckets = [], []
        for n in range(1, max(sizes) + 1):
            m = len(codes) - n + 1
            if m <= 0:
                break
            rolled = rolled[:m] * _BASE + codes[n - 1 :]
            if n not in sizes:
                continue
            inside = owner[:m] == owner[n - 1 :]
            mixed = (rolled[inside] + np.uint64(n + 17 * salt)) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
            mixed *= np.uint64(0xD6E8FEB86659FD93)
            owners.append(owner[:m][inside])
            buckets.append((mixed >> np.uint64(64 - bits)).astype(np.int64))
        if owners:
            yield np.concatenate(owners), np.concatenate(buckets)
        start = end

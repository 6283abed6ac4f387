import random

import pytest

sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")

from chunkwise.llm.packing import fullest, minimum_slack_patterns, pack, slot_table  # noqa: E402
from chunkwise.llm.queries import tokenizer_file  # noqa: E402
from chunkwise.llm.token_counts import PrefixCounter, count_tokens  # noqa: E402

ODD = ["", " ", "  a", "a  ", "a   b\n\n c", "▁x ▁ y", "日本語 テスト 😀😀 x", "<s> </s> <unk> <0x0A>", "a" * 70, "\t\ta b", "éx ́", "İstanbul ﬁ Ａ", "\x00a b\x00", "<|endoftext|>x <|startoftext|>", "it's I'LL we've."]


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(tokenizer_file("piece_bpe_32k.model"))


def test_every_prefix_matches_the_library(counter):
    for text in ODD:
        counts = counter.prefix_counts(text)
        assert counts == [len(counter.sp.encode(text[:i])) for i in range(len(text) + 1)]
        for budget in (0, 1, 3, 9):
            assert counter.longest_prefix(text, budget) == max(i for i, c in enumerate(counts) if c <= budget)


def test_counts_of_a_table(spark, counter):
    rng = random.Random(3)
    texts = [*ODD, None, " ".join(rng.choice(["the", "tion", "und", "x9", "Ñ"]) for _ in range(6000))]
    rows = [(i, t, "n") for i, t in enumerate(texts)] + [(None, "a b", "n"), (3, "a  ", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {(r["doc_id"], r["n_bytes"]): r for r in count_tokens(docs, tokenizer_file("piece_bpe_32k.model"), limit=50).collect()}
    for i, t in enumerate(texts):
        n = len(counter.sp.encode(t or ""))
        r = got[(i, len((t or "").encode()))]
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 50)
        if n > 50:
            assert len(counter.sp.encode((t or "")[: r["cut"]])) <= 50 < len(counter.sp.encode((t or "")[: r["cut"] + 1]))
    assert count_tokens(docs, tokenizer_file("piece_bpe_32k.model")).count() == len(rows)
    assert count_tokens(docs.limit(0), tokenizer_file("piece_bpe_32k.model")).count() == 0


def test_packing_keeps_every_id_once(spark):
    import numpy as np

    tokenizer = tokenizers.Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    rng = random.Random(5)
    texts = [*ODD, None, *[" ".join(rng.choice(["Hello,", "welt", "niño.", "42", "ça"]) for _ in range(rng.randint(1, 300))) for _ in range(60)]]
    rows = [(i, t, 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    pieces = pack(docs, tokenizer_file("word_bpe_49k.json"), capacity=128).collect()
    for i, t in enumerate(texts):
        want = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4").tobytes()
        own = sorted((p for p in pieces if p["doc_id"] == i), key=lambda p: p["start"])
        assert b"".join(bytes(p["ids"]) for p in own) == want
        assert [p["start"] for p in own] == list(range(0, len(want) // 4, 128))
        assert {p["doc_tokens"] for p in own} == {len(want) // 4}
    windows = {}
    for p in pieces:
        windows.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 128
    assert pack(docs.limit(0), tokenizer_file("word_bpe_49k.json")).count() == 0


def test_repeated_and_null_rows_are_packed(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c")], "doc_id long, text string")
    pieces = pack(docs, tokenizer_file("word_bpe_49k.json"), capacity=8, keep_ids=False).collect()
    assert len(pieces) == 3 and len({(p["sequence_id"], p["offset"]) for p in pieces}) == 3


def test_patterns_fill_windows_as_full_as_they_can():
    rng = random.Random(1)
    histogram = {n: rng.randint(1, 40) for n in rng.sample(range(1, 64), 30)}
    patterns = minimum_slack_patterns(dict(histogram), 64)
    used = {}
    for pattern, times in patterns:
        assert sum(n * k for n, k in pattern.items()) <= 64
        for n, k in pattern.items():
            used[n] = used.get(n, 0) + k * times
    assert used == histogram
    # each pattern is the fullest that its longest length allowed: no first fit is better
    windows, room = sum(times for _, times in patterns), []
    for n in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
        k = next((k for k, r in enumerate(room) if r >= n), None)
        if k is None:
            room.append(64 - n)
        else:
            room[k] -= n
    assert windows <= len(room)
    slots = slot_table(patterns)
    for n, c in histogram.items():
        spans = sorted((first, first + ranks) for length, first, ranks, *_ in slots if length == n)
        assert spans[0][0] == 0 and spans[-1][1] == c and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_fullest_is_the_best_subset_sum():
    rng = random.Random(4)
    for _ in range(60):
        counts = {rng.randint(1, 20): rng.randint(1, 3) for _ in range(4)}
        items = [n for n, c in counts.items() for _ in range(c)]
        room = rng.randint(0, 50)
        best = max(t for m in range(1 << len(items)) if (t := sum(n for i, n in enumerate(items) if m >> i & 1)) <= room)
        used = fullest(counts, room)
        assert sum(n * k for n, k in used.items()) == best and all(k <= counts[n] for n, k in used.items())

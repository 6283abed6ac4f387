import hashlib
import random
from collections import Counter

import pytest

sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")

from chunkwise.llm import cross_tokens  # noqa: E402
from chunkwise.llm.cross_tokens import PairEncoder, align, align_texts  # noqa: E402
from chunkwise.llm.queries import tokenizer_file  # noqa: E402

BYTE_FILE, PIECE_FILE = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
ODD = [None, "", " ", "  a", "a  ", "a   b\n\n c", "▁x ▁ y", "日本語 テスト 😀😀 x", "<s> </s> <unk> <0x0A>", "a" * 70, "\t\ta b\x85\x1cc", "\x00a b\x00", "<|endoftext|>x", "it's I'LL we've.", "x\t y \n z\n\n", "zürich\xa0 ab"]


def plain(texts):
    """Everything as the contract states it, token by token."""
    a_lib = tokenizers.Tokenizer.from_file(BYTE_FILE)
    a_lib.encode_special_tokens = True
    spell = PairEncoder(BYTE_FILE, PIECE_FILE)
    b_lib = sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)
    rows, links = [], []
    for text in texts:
        if not text:
            rows.append((0, 0, 0, 0, ""))
            links.append(Counter())
            continue
        ids_a, ids_b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
        bytes_a, bytes_b = ([table.blob[table.start[i] :][: table.length[i]].tobytes() for i in ids] for table, ids in ((spell.bytes_a, ids_a), (spell.bytes_b, ids_b)))
        if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            rows.append((0, 0, 0, 0, ""))
            links.append(Counter())
            continue

        def spans(parts):
            at, out = 0, []
            for p in parts:
                out.append((at, at + len(p)))
                at += len(p)
            return out

        sa, sb = spans(bytes_a), spans(bytes_b)
        own = Counter((i, j) for i, (s, e) in zip(ids_a, sa) for j, (t, f) in zip(ids_b, sb) if s < f and t < e)
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, low = [], 0
        for cut in cuts:
            groups.append(",".join(str(i) for i, (s, e) in zip(ids_a, sa) if low < e <= cut) + "|" + ",".join(str(i) for i, (s, e) in zip(ids_b, sb) if low < e <= cut))
            low = cut
        rows.append((len(ids_a), len(ids_b), len(groups), sum(own.values()), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append(own)
    held = Counter(p for own in links for p in own)
    most = {}
    for (a, _), n in held.items():
        most[a] = max(n, most.get(a, 0))
    sums = [(sum(k for p, k in own.items() if held[p] == most[p[0]]), sum(k * held[p] for p, k in own.items())) for own in links]
    return [(*r[:4], *s, r[4]) for r, s in zip(rows, sums)]


def some_texts(n, seed):
    rng = random.Random(seed)
    words = ["the", "tion", "Über", "x9", "Ñandú", "日本", "a", "reaux,", "éouque.", "and\n", " ", "'s", "\t", "\xa0"]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(n)]


@pytest.mark.parametrize("heads", [0, 40, 1 << 20])
def test_a_table_against_plain_alignment(spark, heads):
    texts = [*ODD, *some_texts(40, 1), "a  "]
    docs = spark.createDataFrame([(i if i != 5 else None, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_a int").repartition(3)
    got = align(docs, BYTE_FILE, PIECE_FILE, heads=heads).collect()
    want = plain(texts)
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert len(got) == len(texts)
    for r in got:
        i = 5 if r["doc_id"] is None else r["doc_id"]
        assert tuple(r[c] for c in columns) == want[i], repr(texts[i])


def test_long_texts_in_parts(monkeypatch):
    enc = PairEncoder(BYTE_FILE, PIECE_FILE)
    texts = [*ODD, *some_texts(10, 2), " ".join(some_texts(30, 3)), "x" * 5000]
    whole = align_texts(enc, texts)
    monkeypatch.setattr(cross_tokens, "slices", lambda text: __import__("chunkwise.llm.bpe", fromlist=["slices"]).slices(text, 20))
    monkeypatch.setattr(cross_tokens, "_PART_BYTES", 64)
    parts = align_texts(enc, texts)
    for c in whole:
        assert list(whole[c]) == list(parts[c]), c


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align(docs, BYTE_FILE, PIECE_FILE).count() == 0

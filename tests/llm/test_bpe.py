import hashlib
import random

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")

from chunkwise.llm.bpe import BytePairCodec, decode_documents, encode_documents, ids_digest, slices  # noqa: E402
from chunkwise.llm.queries import tokenizer_file  # noqa: E402

VOCABULARY = tokenizer_file("byte_bpe_50k.json")
ODD = ["", " ", "  a", "a  ", "a   b\n\n c", "\t\ta b\x85\x1cc", "日本語 テスト 😀😀 x", "a<|endoftext|> b <|endoftext|>", "it's I'LL we've.", "²³ ١٢ ǅ", "\x00a b\x00", "  x", "a" * 300]


@pytest.fixture(scope="module")
def codec():
    return BytePairCodec(VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(VOCABULARY)


def ids_of(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


def random_texts(n, seed):
    rng = random.Random(seed)
    bits = ["a", "b", "th", "ing", " ", "  ", "\n", "\t", "\x1c", "\xa0", "'s", "'ll", "1", "²", "é", "日", "😀", "　", ".", ",", "<|endoftext|>", "aaa", "ſ"]
    for _ in range(n):
        if rng.random() < 0.5:
            yield "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        else:
            yield "".join(chr(rng.choice([rng.randint(1, 0x250), rng.randint(32, 126), rng.randint(1, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(rng.randint(0, 10)))


def test_ids_and_text_are_the_librarys(codec, library):
    for text in [*ODD, *random_texts(4000, 1)]:
        ids = ids_of(codec, text)
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert codec.decode(np.array(ids, np.int64)) == library.decode(ids, skip_special_tokens=False) == text


def test_pieces_of_characters_decode_as_the_library_does(codec, library):
    rng = random.Random(2)
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 6))]
        assert codec.decode(np.array(ids, np.int64)) == library.decode(ids, skip_special_tokens=False)


def merge_slowly(table, word):
    """Byte-pair merging as defined: the first of the earliest merges, until none is left."""
    ids = [table.usable[bytes([b])] for b in word]
    made = {v: k for k, v in enumerate(table.rank) if v >= 0}
    while True:
        ranks = [table.merges.get(a << 32 | b, 1 << 60) for a, b in zip(ids, ids[1:])]
        if not ranks or min(ranks) == 1 << 60:
            return ids
        k = ranks.index(min(ranks))
        ids[k : k + 2] = [made[ranks[k]]]


def test_words_against_merging_step_by_step(codec):
    rng = random.Random(3)
    for _ in range(1500):
        word = bytes(rng.choice(b"aaeinrst th \xc3\xa9\xe6\x97") for _ in range(rng.randint(1, 14)))
        assert codec.encode_word(word.decode("latin-1")) == merge_slowly(codec.table, word), word


def test_pairs_fit_as_merging_says(codec):
    rng = random.Random(4)
    tokens = [t for t in range(2000) if codec.table.bytes[t] in codec.table.usable]
    for _ in range(1500):
        x, y = rng.choice(tokens), rng.choice(tokens)
        joined = codec.table.bytes[x] + codec.table.bytes[y]
        assert codec.table.fits(x, y) == (merge_slowly(codec.table, joined) == [x, y])


def test_long_words_and_slices(codec, library):
    for text in ["a" * 200_000, "ab" * 50_000, "x " * 30_000 + "\n" * 5_000 + "y"]:
        assert ids_of(codec, text) == library.encode(text, add_special_tokens=False).ids
    rng = random.Random(5)
    text = "".join(rng.choice(["ab", " ", "  ", "\n", "c."]) for _ in range(3000))
    parts = list(slices(text, 50))
    assert "".join(parts) == text and len(parts) > 20
    assert sum((ids_of(codec, p) for p in parts), []) == ids_of(codec, text)


def test_a_table(spark, library):
    rows = [(i, t, "n") for i, t in enumerate(ODD)] + [(None, "a b", "n"), (3, "a  ", "n"), (99, None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = encode_documents(docs, VOCABULARY)
    got = decode_documents(encoded, VOCABULARY).withColumn("digest", ids_digest(encoded["ids"])).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t, _ in rows)
    assert sorted((str(r["doc_id"]), r["ids"], r["decoded"]) for r in got) == want
    for r in got:
        assert r["digest"] == hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest()
    plain = encode_documents(docs, VOCABULARY, special=False).where("doc_id = 7").first()["ids"]
    assert 50256 not in plain and decode_documents(encode_documents(docs.limit(0), VOCABULARY), VOCABULARY).count() == 0

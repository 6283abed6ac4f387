"""Decontamination, personal data, URL rules: against brute force on small tables."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from chunkwise.llm import decontamination as dc
from chunkwise.llm import decontamination, pii
from chunkwise.llm import url_filter as uf


def plain(text):
    return "".join(map(chr, dc.plain(text)[0]))


def sellers(item, text):
    """Least edits of ``item`` against any stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        k = rng.randrange(len(chars))
        op = rng.randrange(3)
        if op == 0:
            chars[k] = rng.choice("abcdef ")
        elif op == 1:
            del chars[k]
        else:
            chars.insert(k, rng.choice("abcdef"))
    return "".join(chars)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghé") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_leaks_are_those_within_the_edit_budget(spark):
    rng = random.Random(2)
    items = [words(rng, rng.randint(8, 30)) for _ in range(12)]
    texts = ["", None, "!!!", items[0], items[1].upper() + "!", words(rng, 50)]
    for k in range(60):
        item = rng.choice(items)
        share = rng.choice([0, 0.05, 0.09, 0.1, 0.12, 0.2])
        texts.append(words(rng, rng.randint(0, 60)) + " " + edited(rng, item, int(len(item) * share)) + " " + words(rng, rng.randint(0, 60)))
    texts.append(" ".join(words(rng, 30) + " " + items[3] for _ in range(5)))
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(98, None), (99, "ab")], "item_id long, text string")
    got = dc.find_leaks(docs, bench).collect()
    want = set()
    for d, t in enumerate(texts):
        for i, item in enumerate(items):
            p = plain(item)
            if sellers(p, plain(t or "")) <= int(len(p) * 0.1):
                want.add((d, i))
        if " ab " in f" {plain(t or '')} ":  # too short for edits: a whole word
            want.add((d, 99))
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    for r in got:
        span = plain(texts[r["doc_id"]][r["start"] : r["end"]])
        p = plain({**dict(enumerate(items)), 99: "ab"}[r["item_id"]])
        assert sellers(p, span) == r["edits"] <= int(len(p) * 0.1)
    assert sum(r["doc_id"] == len(texts) - 1 and r["item_id"] == 3 for r in got) == 5
    left = dc.without_leaks(docs, bench)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == set(range(len(texts))) - {d for d, _ in want}
    assert dc.find_leaks(docs, bench.limit(0)).count() == 0 and dc.find_leaks(docs.limit(0), bench).count() == 0
    blocks = dc.find_leaks(docs, bench, block_chars=300).collect()
    assert {tuple(r) for r in blocks} == {tuple(r) for r in got}


def test_long_texts_are_searched_in_windows(monkeypatch):
    rng = random.Random(4)
    item = words(rng, 20)
    monkeypatch.setattr(dc, "_WINDOW", 500)
    block = dc.Block.build([(7, dc.plain(item)[0])], 0.1, 8)
    for at in range(0, 1200, 37):
        text = words(rng, 400)[:at] + " " + item + " " + words(rng, 300)
        assert [r["item_id"] for r in block.leaks([text])[0]] == [7]


def test_alignment_is_the_best_of_its_band():
    rng = random.Random(6)
    for _ in range(60):
        item, text = words(rng, 4), words(rng, 12)
        a, b = (np.frombuffer(x.encode("utf-32-le"), dtype="<u4") for x in (item, text))
        edits, start, end = dc.alignment(a, b, -len(item), len(text))
        assert edits == sellers(item, text) and sellers(item, text[start:end]) == edits


FORMATS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    digits = [int(c) for c in s if c.isdigit()]
    total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
    return 16 <= len(digits) <= 19 and total % 10 == 0


def base_spans(text):
    keep = {"email": lambda m: True, "ip": lambda m: all(int(p) <= 255 for p in m.split(".")), "card": luhn, "phone": lambda m: 8 <= sum(map(str.isdigit, m)) <= 15}
    return [f"{k}:{m.start()}:{m.end()}" for k, p in FORMATS.items() for m in re.finditer(p, text or "") if keep[k](m.group())]


PII_TEXTS = [
    None, "", "a@b.c_d@e.f x.y@z", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111",
    "+1 (988) 555-2485, +49.30.1234567 +1 2 +123456789012345678", "ü😀 a.b@mail.example.com 😀 10.0.0.1", "1 " * 3000, "a" * 30000 + "@", "." * 2000 + "1" * 20000,
    "mail me@x.org me@x.org", "+1 4111 1111 1111 1111 x", "@ @@ a@ @b", "9" * 17, "0000 0000 0000 0000",
]


def test_base_spans_match_the_plain_expressions(spark):
    rng = random.Random(8)
    noisy = ["".join(rng.choice("a1.@+ -(4") for _ in range(rng.randint(1, 200))) for _ in range(150)]
    texts = PII_TEXTS + noisy
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "a@b.cd", "x")], "doc_id long, text string, email string")
    found = pii.find_pii(docs, bootstrap=False).select("doc_id", pii.span_text(found_col("base")).alias("s")).collect()
    got = {r["doc_id"]: r["s"] for r in found}
    for i, t in enumerate(texts):
        assert got[i] == ",".join(base_spans(t)), t
    assert got[None] == "email:0:6"


def found_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    rng = random.Random(9)
    filler = ["the", "road", "was", "long", "and", "cold"]
    texts = []
    for k in range(30):
        a, b = (" ".join(rng.choice(filler) for _ in range(20)) for _ in range(2))
        texts.append(f"{a} phone no: +1 (555) 010-{1000 + k} {b}")
    texts += [f"some words phone no: 555-010-{2000 + k} and more" for k in range(3)]
    clean = [" ".join(rng.choice(filler) for _ in range(30)) + f" the {rng.randint(1000000, 9999999)} " for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts + clean)), "doc_id long, text string")
    rows = {r["doc_id"]: r["found"]["phone"] for r in pii.find_pii(docs).collect()}
    for k in range(30, 33):
        assert [texts[k][s["start"] : s["end"]] for s in rows[k]] == [f"555-010-{1970 + k}"]
    assert all(len(rows[k]) == 1 for k in range(30)) and not any(rows[k] for k in range(33, 63))
    masked = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert masked[31] == "some words phone no: <PHONE> and more"
    assert [masked[k] for k in range(33, 63)] == clean
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_redaction_covers_overlaps_and_keeps_rows(spark):
    docs = spark.createDataFrame([(1, "x +100.200.100.200 y", 2), (1, "x +100.200.100.200 y", 2), (None, None, None), (3, "me@x.org", 5)], "doc_id long, text string, row_id int")
    rows = sorted(map(tuple, pii.redact(docs).collect()), key=str)
    assert len(rows) == 4 and (3, "<EMAIL>", 5) in rows and (None, None, None) in rows
    assert rows.count((1, "x <PHONE> y", 2)) == 2


def test_span_digest_is_of_the_text(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "me@x.org")], "doc_id long, text string")
    found = pii.find_pii(docs, bootstrap=False)
    row = found.select(F.sha2(pii.span_text(F.col("base")).cast("binary"), 256).alias("h")).first()
    assert row["h"] == hashlib.sha256(b"email:0:8").hexdigest()


RULES = [uf.Rule("net", "/", "block"), uf.Rule("example.net", "/en/", "allow"), uf.Rule("example.com", "/de/", "block"), uf.Rule("org", "/fr/", "allow")]


def brute_rule(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name)) if fits else None


def test_url_rules_and_learned_verdicts(spark):
    urls = [None, "", "x", "http://", "HTTP://A.NET", "http://a.NET/", "http://example.net/en/x", "http://m.example.net/en/?a", "http://badexample.net/en/x", "http://x.com?y=/de/", "a://b://c.net/",
            "http://Éx.com/É", "http://a.b.example.com/de/1#f", "http://q.org/fr/", "http://q.org/fr", "http://net/", "http://a.net?x/"]
    urls += [f"https://spam{i}.net/buy/{i}" for i in range(40)] + [f"https://good{i}.org/fr/{i}" for i in range(40)] + ["https://new.com/buy/7", "https://fine.com/fr/7"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    model = uf.train(uf.labelled_by_rules(pages, RULES))
    got = {r["page_id"]: r for r in uf.judge(pages, RULES, model).collect()}
    for i, u in enumerate(urls):
        host, path, rule = brute_rule(u)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.name if rule else None), u
        assert r["verdict"] in ("allow", "block") and (rule is None or r["verdict"] == rule.verdict)
    assert got[len(urls) - 2]["verdict"] == "block" and got[len(urls) - 1]["verdict"] == "allow"
    none = uf.train(uf.labelled_by_rules(pages.limit(0), RULES))
    assert {r["verdict"] for r in uf.judge(pages.where("page_id < 3"), RULES, none).collect()} == {"allow"}
    assert uf.judge(pages.limit(0), RULES, model).count() == 0


def test_short_items_are_found_as_whole_words(spark):
    items = [(1, "What is 2 plus 2?"), (2, "Yes!"), (3, "日本の首都はどこですか"), (4, "首都"), (5, "?!")]
    docs = [(1, "He asked: what is 2  plus 2? A: four"), (2, "yesterday"), (3, "oh yes, sure"), (4, "問題:日本の首都はどこですか。"), (5, ""), (6, None), (7, "what iss 2 plus 2")]
    found = decontamination.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert got == {(1, 1), (3, 2), (4, 3), (4, 4), (7, 1)}


def test_repetitive_texts_take_bounded_memory(spark):
    import tracemalloc

    from chunkwise.llm.decontamination import Block, plain

    block = Block.build([(1, plain("a" * 300)[0]), (2, plain("ab " * 90)[0])], 0.1, 8)
    tracemalloc.start()
    found = block.leaks(["a" * 1_000_000])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6 and len(found) > 3000 and {f["item_id"] for f in found} == {1}


def test_blocks_of_the_benchmark_give_the_same(spark):
    rows = [(i, f"{w} " * 9 + "end") for i, w in enumerate(["alpha", "beta", "gamma", "delta"])]
    docs = spark.createDataFrame([(i, t) for i, t in rows] + [(9, "clean words only")], "doc_id long, text string")
    items = spark.createDataFrame(rows[:3], "item_id long, text string")
    for block_chars in (10, 4_000_000):
        assert {r["doc_id"] for r in decontamination.without_leaks(docs, items, block_chars=block_chars).collect()} == {3, 9}
        assert {r["doc_id"] for r in decontamination.find_leaks(docs, items, block_chars=block_chars).collect()} == {0, 1, 2}
    assert decontamination.without_leaks(docs.limit(0), items).count() == 0


def test_words_with_digits_are_contexts_too(spark):
    rng = random.Random(8)
    seeds = [(i, f"call tel2: +1 555 {rng.randint(1000000, 9999999)} now") for i in range(12)]
    docs = spark.createDataFrame([*seeds, (50, "his tel2: 555-010-1000 is new"), (51, "room 555-010-1001 is free")], "doc_id long, text string")
    spans = {r["doc_id"]: r["s"] for r in pii.find_pii(docs).select("doc_id", pii.span_text(F.col("found")).alias("s")).collect()}
    assert spans[50] == "phone:10:22" and spans[51] == ""
    masked = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert masked[50] == "his tel2: <PHONE> is new" and masked[0] == "call tel2: <PHONE> now" and masked[51] == "room 555-010-1001 is free"
    assert pii.redact(docs.limit(0)).count() == 0


def test_patterns_are_found_over_many_rounds(spark):
    """Each round's patterns find the identifiers that the next one's patterns are learned from."""
    rows, n = [], 0

    def add(word, value):
        nonlocal n
        rows.append((n, f"a b {word} {value}"))
        n += 1

    words = [f"w{'x' * level}0" for level in range(6)]
    for k in range(6):
        for _ in range(4):
            add(words[0], f"+1 555 010 {k:04d}")
    for level in range(5):
        for k in range(6):
            number = f"555-{level:03d}-{k:04d}"
            add(words[level], number)  # learned from what stands four times behind this word
            for _ in range(4):
                add(words[level + 1], number)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r["doc_id"]: r["s"] for r in pii.find_pii(docs).select("doc_id", pii.span_text(F.col("found")).alias("s")).collect()}
    assert all(spans[i] for i, _ in rows)

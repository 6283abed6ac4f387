"""Language identification, toxicity and nearest neighbours: held-out accuracy and brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkwise.llm import ann, boosting, langid, toxicity
from chunkwise.llm.common import id_remainder

SYLLABLES = {"aa": ["the", "ing", "wh", "tion", "ea"], "bb": ["sch", "ung", "ü", "keit", "ei"], "cc": ["ción", "ñ", "os", "rr", "ez"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_language_of_held_out_rows(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, lang, rng.randint(3, 60)), lang, "x") for i, lang in enumerate(rng.choice(sorted(SYLLABLES)) for _ in range(240))]
    odd = [(1000, None, "aa", "x"), (1001, "", "bb", "x"), (1002, "123 ½ ²!", None, "x"), (1003, prose(rng, "bb", 5000), None, "x"), (None, prose(rng, "cc", 9), "cc", "x")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string")
    model = langid.train(docs, learn=id_remainder(F.col("doc_id"), 4) != 2, docs_per_language=100)
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    right = sum(got[i]["lang_pred"] == lang for i, _, lang, _ in rows)
    assert right >= 0.97 * len(rows)
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "bb"]
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[1000]["score"] == 0
    assert langid.identify(docs.limit(0), model).count() == 0
    empty = langid.train(docs, learn=F.lit(False))
    assert {r["lang_pred"] for r in langid.identify(docs.limit(5), empty).collect()} == {"und"}
    again = langid.train(docs.repartition(3), learn=id_remainder(F.col("doc_id"), 4) != 2, docs_per_language=100)
    assert np.array_equal(again.scores, model.scores)


def test_toxicity_of_held_out_rows(spark):
    rng = random.Random(2)
    bad = ["grok", "blarg", "snarf", "zonk"]
    rows, marks = [], []
    for i in range(500):
        words = prose(rng, "aa", rng.randint(5, 60)).split()
        toxic = int(rng.random() < 0.3)
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), 0.5))
        marks.append((i, toxic, 1))
    odd = [(1000, None, 0.5), (1001, "", 0.5), (None, "zonk", 0.5), (1002, "z0nk!!", 0.5), (1003, "the tion " * 4000 + "zonk " * 400, 0.5)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, score double")
    labels = spark.createDataFrame(marks + [(3, None, 1), (None, 1, 1), (5, marks[5][1], 1)], "doc_id long, toxic int, text int")
    model = toxicity.train(docs, labels, learn=id_remainder(F.col("doc_id"), 5) != 0, rows_per_class=400)
    got = {r["doc_id"]: r for r in toxicity.score_documents(docs, model).collect()}
    held = {r["doc_id"] for r in docs.where(id_remainder(F.col("doc_id"), 5) == 0).select("doc_id").collect()} & set(range(500))
    assert sum(got[i]["predicted"] == marks[i][1] for i in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    assert got[1000]["score"] == got[1001]["score"] < 0.5 and got[None]["predicted"] == 1
    assert toxicity.score_documents(docs.limit(0), model).count() == 0
    single = toxicity.train(docs, labels.where("toxic = 0"), learn=F.lit(True))
    assert {r["score"] for r in toxicity.score_documents(docs, single).collect()} == {0.0}


def test_disguises_are_undone():
    assert toxicity.undisguised("Z0nk!!") == "zonk" and toxicity.undisguised("z-o-n-k") == "zonk" and toxicity.undisguised("zooooonk") == "zonk"


def test_isotonic_map_is_monotone_and_pools():
    rng = np.random.default_rng(3)
    score = rng.normal(size=400)
    y = (rng.random(400) < 1 / (1 + np.exp(-2 * score))).astype(float)
    at, to = boosting.fit_isotonic(score, y, np.ones(400))
    assert (np.diff(at) >= 0).all() and (np.diff(to) >= 0).all()
    fitted = np.interp(score, at, to)
    assert abs(fitted.mean() - y.mean()) < 1e-9


def test_trees_learn_a_function_of_two_features():
    rng = np.random.default_rng(4)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = boosting.fit_trees(x, y, np.ones(600))
    assert ((model.raw(x) > 0) == (y == 1)).mean() > 0.97


def brute(ids, vectors, k):
    """Per query its nearest, as (vec_id, score)."""
    out = {}
    for i, q in zip(ids, vectors):
        if i % 20 == 0:
            scored = sorted(((-float(np.dot(q, v)), j) for j, v in zip(ids, vectors) if j != i and len(v) == len(q)))
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def test_neighbours_of_few_vectors_are_exact(spark):
    rng = np.random.default_rng(5)
    vectors = [rng.normal(size=12).round(2).tolist() for _ in range(120)]
    vectors[7] = vectors[40] = vectors[41] = vectors[0]
    odd = [(500, None), (501, [0.0] * 12), (502, [1.0] * 11 + [None]), (503, [float("nan")] + [1.0] * 11), (504, []), (None, [1.0] * 12), (520, [1.0, 2.0]), (521, [3.0, 1.0])]
    rows = [(i, v, i) for i, v in enumerate(vectors)] + [(i, v, 0) for i, v in odd]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in ann.search(table, F.col("vec_id") % 20 == 0, k=20).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute([*range(120), 520, 521], [np.array(v) for v in [*vectors, [1.0, 2.0], [3.0, 1.0]]], 20)
    assert set(got) == set(want)
    for q, near in want.items():
        assert [j for j, _ in got[q]] == [j for j, _ in near]
        assert np.allclose([s for _, s in got[q]], [s for _, s in near])
    assert ann.search(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_recall_of_probed_cells_and_split_blocks(spark):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(3000, 32))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[:1000] = vectors[0]  # a third of all rows in one cell
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").where("vec_id % 20 = 0 OR vec_id % 3 = 0 OR vec_id >= 1000")
    kept = sorted(r["vec_id"] for r in table.select("vec_id").collect())
    got = {}
    for r in ann.search(table, F.col("vec_id") % 60 == 0, k=10, block_rows=100, exact_rows=0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute(kept, [vectors[i] for i in kept], 10)
    shares = [len(got[q] & {j for j, _ in near}) / 10 for q, near in want.items() if q % 60 == 0 and q >= 1000]
    assert np.mean(shares) >= 0.9
    ties = [q for q in got if q < 1000]
    assert all(got[q] == set([i for i in kept if i < 1000 and i != q][:10]) for q in ties)


def test_recall_of_default_probes_on_vectors_without_structure(spark):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(4000, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(table, F.col("vec_id") % 20 == 0, k=20).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute(range(4000), vectors, 20)
    assert np.mean([len(got[q] & {j for j, _ in near}) / 20 for q, near in want.items()]) >= 0.96


def test_short_queries_are_widened_and_small_tables_probed_alike(spark):
    rng = np.random.default_rng(9)
    axis = np.zeros(64)
    axis[0] = 1.0
    near = [(axis + 0.01 * rng.normal(size=64)).tolist() for _ in range(5)]  # all in few cells, far from the others
    rows = [(20 * i, v) for i, v in enumerate(near)] + [(1001 + i, (-axis + 0.01 * rng.normal(size=64)).tolist()) for i in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(table, F.col("vec_id") % 20 == 0, k=20, probes=1).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    want = brute([i for i, _ in rows], [np.array(v) for _, v in rows], 20)
    assert {q: sorted(n) for q, n in got.items()} == {q: sorted(j for j, _ in n) for q, n in want.items()}
    few = rng.normal(size=(1000, 64)).tolist()
    few = spark.createDataFrame(list(enumerate(few)), "vec_id long, embedding array<double>")
    is_query = F.col("vec_id") % 20 == 0
    assert ann.recall(ann.search(few, is_query, probes=8), few, is_query) < 0.9  # no exact search hides the probes
    assert ann.recall(ann.search(few, is_query, probes=128), few, is_query) == 1.0


def test_recall_holds_for_many_dimensions_and_unequal_lengths(spark):
    rng = np.random.default_rng(10)
    is_query = F.col("vec_id") % 20 == 0
    flat = rng.normal(size=(2500, 128))
    flat /= np.linalg.norm(flat, axis=1, keepdims=True)
    uneven = rng.normal(size=(2500, 64))
    uneven *= np.exp(rng.normal(size=(2500, 1))) / np.linalg.norm(uneven, axis=1, keepdims=True)
    for vectors in (flat, uneven):
        table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
        assert ann.recall(ann.search(table, is_query), table, is_query) >= 0.95


def test_bands_that_lose_most_for_their_size_are_searched_whole():
    reach = {0: {0: 800, 70: 10}, 5: {0: 40, 90: 150}}
    assert ann.bands_searched_whole(reach, {0: 9000, 5: 50, -3: 4000}, 64, 0.95) == {5}
    assert ann.bands_searched_whole({0: {3: 4000}}, {0: 9000}, 64, 0.95) == set()
    assert ann.bands_searched_whole({0: {3: 20}}, {0: 21}, 64, 0.95) == {0}
    assert ann.bands_searched_whole({}, {0: 1}, 64, 0.95) == set()


@pytest.mark.parametrize("texts", [["same"] * 40, [None] * 40, [""] * 40, ["same", None] * 20])
def test_equal_texts_with_both_labels(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i // 2 % 2) for i in range(40)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, learn=F.lit(True))
    assert all(0 <= r["score"] <= 1 for r in toxicity.score_documents(docs, model).collect())

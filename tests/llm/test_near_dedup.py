import random

import numpy as np
from pyspark.sql import functions as F

from chunkwise.llm import near_dedup as nd
from chunkwise.llm.components import connected_components


def shingles(text, w):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < w else frozenset(tuple(words[i : i + w]) for i in range(len(words) - w + 1))


def brute(rows, w, threshold=80):
    sets = [shingles(t, w) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return sorted([(rows[i][0], len(sets[i]), least[find(i)], rows[i][0] == least[find(i)]) for i in range(len(rows))], key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["THE", "of", "Ñ"]
    rows = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 90))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, max(0, len(copy) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((None, " ".join(copy)))
    rng.shuffle(rows)
    rows = [(i * 3, t) for i, (_, t) in enumerate(rows)]
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "one"), (1004, "ONE\x0b"), (1005, "one "), (1006, "a b"), (1007, "b a"), (None, "a b"), (None, "lonely words here now")]
    rows += [rows[0], rows[1]]
    return rows


def run(spark, rows, w):
    docs = spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, key string")
    return sorted(map(tuple, nd.near_duplicates(docs, shingle=w).collect()), key=str)


def test_components_match_brute_force(spark):
    rows = corpus(1)
    assert run(spark, rows, 2) == brute(rows, 2)
    assert run(spark, rows, 5) == brute(rows, 5)


def test_large_groups_go_deeper_and_stay_whole(spark, monkeypatch):
    monkeypatch.setattr(nd, "REGION", 8)
    monkeypatch.setattr(nd, "BLOCK", 16)
    rng = random.Random(7)
    base = [f"w{rng.randint(0, 300)}" for _ in range(120)]
    rows = []
    for i in range(70):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 999)}"
        rows.append((i, " ".join(copy)))
    far = list(base)
    for k in range(0, 120, 11):
        far[k] = "zz"  # linked with few of the group, if any
    rows.append((500, " ".join(far)))
    rows += [(600 + i, " ".join(base)) for i in range(30)]
    assert run(spark, rows, 2) == brute(rows, 2)


def test_pairs_at_the_threshold_in_cut_regions_are_linked(spark, monkeypatch):
    monkeypatch.setattr(nd, "REGION", 2)
    rows = []
    for i in range(260):
        base = [f"p{i}w{k}" for k in range(90)]
        fringe = base[:80] + [f"p{i}x{k}" for k in range(10)]  # shares 80 of 100 with base, less with the others
        rows += [(4 * i + j, " ".join(t)) for j, t in enumerate([base, [*base, "y"], [*base, "z"], fringe])]
    assert run(spark, rows, 1) == brute(rows, 1)


def test_regions_that_are_all_cut(spark, monkeypatch):
    monkeypatch.setattr(nd, "REGION", 1)
    base = [f"w{k}" for k in range(90)]
    rows = [(1, " ".join(base)), (2, " ".join([*base, "y"])), (3, "a b c")]
    assert run(spark, rows, 1) == brute(rows, 1)


def test_one_of_each_keeps_columns_and_one_row(spark):
    rows = corpus(2)
    docs = spark.createDataFrame([(d, t, "s") for d, t in rows], "doc_id long, text string, nid string")
    kept = nd.one_of_each(docs, shingle=5)
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"] for r in kept.collect()), key=str)
    want = sorted({d for d, _, _, keep in brute(rows, 5) if keep and d is not None} | set()) + [None, None]
    assert got == sorted(want, key=str)


def test_empty_and_wordless_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert nd.near_duplicates(docs).count() == 0 and nd.one_of_each(docs).count() == 0
    only = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, nd.near_duplicates(only).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_connected_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (130, 129), (60, 61)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 131)} | {61: 60}
    assert got == want


def test_rows_that_share_an_id_are_judged_apart(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (2, a), (2, b), (3, b + " more"), (4, "x"), (4, "x"), (5, ""), (5, None), (5, None), (6, a + " z"), (6, a + " y"), (None, a)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, key int")
    kept = nd.one_of_each(docs, shingle=5, threshold=80)
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(1, a), (2, b), (4, "x"), (5, ""), (5, None), (None, a)], key=str) and kept.columns == docs.columns
    own = spark.createDataFrame([(6, a + " z"), (6, a + " y"), (7, b)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in nd.one_of_each(own).collect()) == [6, 7]


def test_only_wanted_sets_and_signatures_are_computed_and_moved(spark, monkeypatch):
    monkeypatch.setattr(nd, "REGION", 8)
    plans, keep = {}, nd.materialize

    def noted(df, name="table"):
        plans.setdefault(name, []).append(df._jdf.queryExecution().optimizedPlan().toString())
        return keep(df, name)

    monkeypatch.setattr(nd, "materialize", noted)
    base = [f"w{k}" for k in range(90)]
    rows = [(i, " ".join([*base, f"x{i}"])) for i in range(30)] + [(100 + i, " ".join(f"y{i}w{k}" for k in range(60))) for i in range(30)]
    rows += [(None, " ".join([*base, "no id"])), (None, "y0w1"), (7, " ".join([*base, "same id"])), (7, "other words")]
    assert run(spark, rows, 2) == brute(rows, 2)
    # sets and regions of greater depth are made above the joins that pick their rows
    assert plans["sets"] and plans["deeper"]
    for plan in plans["sets"] + plans["deeper"]:
        assert "ArrowEvalPython" in plan and "ArrowEvalPython" not in plan[plan.index("Join"):]


def loose_group(n, seed):
    """Texts of one group that are similar by estimate, of which hardly any are linked."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(n):
        copy = list(base)
        for k in rng.sample(range(120), 12):
            copy[k] = f"x{i}w{k}"
        rows.append((i, " ".join(copy)))
    return rows


def test_loose_groups_never_become_rows_or_lists_of_pairs(spark, monkeypatch):
    monkeypatch.setattr(nd, "REGION", 32)
    kept, keep = [], nd.materialize

    def noted(df, name="table"):
        kept.append((name, keep(df, name)))
        return kept[-1][1]

    monkeypatch.setattr(nd, "materialize", noted)
    n = 300
    rows = loose_group(n, 3)
    rows += [(1000 + i, rows[i][1] + " y") for i in range(0, 20)]  # each linked with one of the group
    assert run(spark, rows, 1) == brute(rows, 1)
    for name, df in kept:
        lists = [c for c, t in df.dtypes if t.startswith("array") and c != "elements"]
        sizes = sum((F.size(c) for c in lists), F.lit(1))
        assert (df.agg(F.sum(sizes)).first()[0] or 0) < n * nd.TREES * 2, name


def test_links_in_a_grid_of_cells(spark, monkeypatch):
    """Members and asking nodes in several parts, cut by elements as well as by nodes."""
    monkeypatch.setattr(nd, "REGION", 16)
    monkeypatch.setattr(nd, "BLOCK", 8)
    monkeypatch.setattr(nd, "BLOCK_ELEMENTS", 700)
    rows = loose_group(90, 5)
    rng = random.Random(9)
    for i in range(60):  # near the threshold, on both sides
        words = rows[rng.randrange(90)][1].split()
        for k in rng.sample(range(120), rng.randint(8, 16)):
            words[k] = f"z{i}w{k}"
        rows.append((200 + i, " ".join(words)))
    assert run(spark, rows, 1) == brute(rows, 1)


def test_common_elements_and_spanning_links():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 9000, rng.integers(1, 6000))) for _ in range(9)] + [np.array([-5]), np.array([-5])]
    both = nd.common_elements(sets)
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert all(both[i][j] == want[i][j] for i in range(11) for j in range(11) if i != j)
    linked = np.zeros((6, 6), dtype=bool)
    for i, j in [(0, 1), (1, 2), (0, 2), (3, 4), (2, 5)]:
        linked[i, j] = linked[j, i] = True
    # 0 and 5 are one component, 3 and 4 another: two links connect the rest
    found = list(nd._spanning(linked, np.array([0, 1, 2, 3, 3, 0])))
    assert len(found) == 2 and {n for link in found for n in link} & {1, 2} == {1, 2} and all(linked[i, j] for i, j in found)

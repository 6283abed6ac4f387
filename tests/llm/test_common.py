import re

from chunkwise.llm import common
from chunkwise.llm.ngrams import hashed_ngrams
from chunkwise.llm.queries import ORACLES, QUERIES


def test_word_cache_is_bounded_and_right():
    asked = []
    cache = common.WordCache(lambda words: (asked.extend(words), [w.upper() for w in words])[1], limit=3, longest=4)
    texts = ["a b a c", "d e", "a f g h", "toolong a toolong"]
    for t in texts:
        assert cache.values(t.split()) == [w.upper() for w in t.split()]
        assert len(cache.young) <= 4 and "toolong" not in cache.young
    assert asked.count("a") <= 2  # the old generation still knew it


def test_a_worker_keeps_one_thing():
    made = []
    for key in ("x", "x", "y", "x"):
        common.resident(key, lambda key=key: made.append(key) or [key])
    assert made == ["x", "y", "x"]


def test_rows_are_dropped_by_id(spark):
    docs = spark.createDataFrame([(i if i % 7 else None, "t", i) for i in range(200)], "doc_id long, text string, bucket int")
    ids = spark.createDataFrame([(i,) for i in range(1, 50)], "doc_id long")
    left = common.drop_ids(docs, "doc_id", ids)
    assert left.columns == docs.columns
    assert sorted(r["bucket"] for r in left.collect()) == [i for i in range(200) if not (i % 7 and i < 50)]
    near = {r["doc_id"] for r in common.in_buckets(docs, "doc_id", ids).collect()}
    assert {i for i in range(1, 50) if i % 7} <= near
    assert common.drop_ids(docs, "doc_id", ids.limit(0)).count() == 200


def test_ngrams_are_those_of_each_string():
    def owners(strings):
        found = {}
        for owner, bucket in hashed_ngrams(strings, (2, 3), 40):
            for o, b in zip(owner.tolist(), bucket.tolist()):
                found.setdefault(o, []).append(b)
        return found

    together = owners(["ab", "", "äb", "ab"])
    alone = [owners([s])[0] for s in ("ab", "", "äb", "ab")]
    assert [sorted(together[k]) for k in range(4)] == [sorted(x) for x in alone]
    assert len(alone[0]) == 3 + 2 and len(alone[1]) == 1 and set(alone[0]) != set(alone[2])


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)

"""Randomised checks of the scalar functions against plain-Python statements of
their rules (one Spark job per property, many values per job)."""

import json
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chunkwise.functions import canonical_labels, qualified_name, size_pretty


def py_size_pretty(b: int) -> str:
    # below 10 kB: plain bytes; then each unit keeps one extra bit and rounds half up
    mag = abs(b)
    if mag < 10 * 1024:
        return f"{b} bytes"
    sign = "-" if b < 0 else ""
    for name, shift in (("kB", 9), ("MB", 19), ("GB", 29), ("TB", 39)):
        if (mag >> shift) < 20 * 1024 - 1:
            return f"{sign}{((mag >> shift) + 1) >> 1} {name}"
    return f"{sign}{((mag >> 49) + 1) >> 1} PB"


def py_quote(name: str) -> str:
    if re.fullmatch(r"[a-z_][a-z0-9_]*", name):
        return name
    return '"' + name.replace('"', '""') + '"'


COMMON = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))


@COMMON
@given(st.lists(st.integers(min_value=-(2**62), max_value=2**62), min_size=50, max_size=200))
def test_size_pretty_matches_rule(spark, values):
    vals = values + [0, 10239, 10240, 20479 << 9, (20479 << 9) - 1, 1 << 40, 1 << 50, 1 << 60]
    df = spark.createDataFrame([(v,) for v in vals], "b long")
    got = {r.b: r.p for r in df.select("b", size_pretty("b").alias("p")).collect()}
    assert all(got[v] == py_size_pretty(v) for v in vals)


@COMMON
@given(st.lists(st.text(alphabet=st.sampled_from('abcXYZ_09"$ .-'), min_size=1, max_size=12), min_size=20, max_size=80))
def test_quoting_matches_rule(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.q for r in df.select(qualified_name("n", "n").alias("q")).collect()]
    assert got == [f"{py_quote(n)}.{py_quote(n)}" for n in names]


@COMMON
@given(st.lists(st.dictionaries(st.text(alphabet="abcdef_", min_size=1, max_size=5),
                                st.text(alphabet="xyz'\" 1", max_size=5), min_size=1, max_size=5),
                min_size=10, max_size=40))
def test_canonical_labels_sorted_keys(spark, label_sets):
    rows = [(json.dumps(d),) for d in label_sets] + [(json.dumps(dict(reversed(list(d.items())))),) for d in label_sets]
    df = spark.createDataFrame(rows, "l string")
    got = [r.c for r in df.select(canonical_labels("l").alias("c")).collect()]
    want = [json.dumps(dict(sorted(d.items())), separators=(",", ":"), ensure_ascii=False) for d in label_sets]
    assert got == want + want

from chunkwise.operators import placement as P


def _ht(spark, names, nodes=("dn1", "dn2", "dn3")):
    return spark.createDataFrame(
        [("prom_data", n, list(nodes), 1) for n in names],
        "hypertable_schema string, hypertable_name string, data_nodes array<string>, num_chunks long",
    )


def test_numbering_is_dense(spark):
    t = P.numbered_tables(_ht(spark, [f"t{i}" for i in range(30)]))
    assert sorted(r.num for r in t.collect()) == list(range(1, 31))


def test_block_plan_rules(spark):
    ht = _ht(spark, ["a", "b", "c"])
    num = {r.hypertable_name: r.num for r in P.numbered_tables(ht).collect()}
    plan = P.block_plan(ht, [(0, "dn7"), (2, "dn3")]).collect()
    dn7 = sorted(r.hypertable_name for r in plan if r.dn == "dn7")
    dn3 = sorted(r.hypertable_name for r in plan if r.dn == "dn3")
    assert dn7 == ["a", "b", "c"]  # rule 0 matches every table
    assert dn3 == sorted(n for n, k in num.items() if k != 2)  # rule k exempts table k
    assert P.block_plan(ht, []).count() == 0


def test_effective_placement(spark):
    ht = _ht(spark, ["a", "b"])
    block = P.block_plan(ht, [(0, "dn3"), (0, "dn1")])
    allow = P.allow_plan(ht, ["dn1"])
    got = {r.hypertable_name: r.allowed_nodes for r in P.effective_placement(ht, block, allow).collect()}
    assert got == {"a": ["dn1", "dn2"], "b": ["dn1", "dn2"]}
    # blocking every node leaves an empty list, not a missing table
    all_blocked = P.block_plan(ht, [(0, "dn1"), (0, "dn2"), (0, "dn3")])
    got = {r.hypertable_name: r.allowed_nodes for r in P.effective_placement(ht, all_blocked).collect()}
    assert got == {"a": [], "b": []}

import random

import pytest
from pyspark.sql import functions as F

from tesserae.operators import hierarchy as h
from tesserae.operators.skew import skew_lookup


def brute(parent):
    """node -> (root, state, depth) by walking up one step at a time."""
    out = {}
    for n in parent:
        trail, at = [], n
        while at is not None and at not in trail:
            trail.append(at)
            at = parent[at]
        if at is None:
            out[n] = (trail[-1], "tree", len(trail) - 1)
        else:
            ring = trail[trail.index(at):]
            out[n] = (min(ring), "cycle", 0) if n in ring else (min(ring), "below_cycle", len(trail) - len(ring))
    return out


def tree(spark, parent, **options):
    df = spark.createDataFrame(list(parent.items()), "node long, parent long")
    return {r["node"]: r for r in h.hierarchy(df, **options).collect()}


@pytest.mark.parametrize("most", [8_000_000, 30, 3])
def test_random_forests_with_cycles(spark, most):
    rng = random.Random(5)
    parent = {n: rng.choice([None, *range(60)]) if rng.random() < 0.9 else None for n in range(60)}
    parent |= {100: 101, 101: 102, 102: 100, 103: 102, 104: 104, 105: 104}
    parent |= {n: n - 1 if n > 200 else None for n in range(200, 240)}
    got, want = tree(spark, parent, most=most), brute(parent)
    assert {n: (r["root_id"], r["node_state"], r["depth"]) for n, r in got.items()} == want
    for n, r in got.items():
        assert r["path"][-1] == n and len(r["path"]) == r["depth"] + 1
        assert all(parent[b] == a for a, b in zip(r["path"], r["path"][1:]))
        below = [m for m in want if m != n and (n in got[m]["path"][:-1] or (want[n][1] == "cycle" and want[m][0] == want[n][0]))]
        assert r["n_descendants"] == len(below)


@pytest.mark.parametrize("most", [8_000_000, 3])
def test_states_without_paths(spark, most):
    parent = {1: None, 2: 1, 3: 2, 4: 5, 5: 6, 6: 7, 7: 4, 8: 7, 9: 8, 10: 10} | {n: n - 1 for n in range(21, 260)} | {20: None}
    got, want = tree(spark, parent, most=most, paths=False), brute(parent)
    assert {n: (r["root_id"], r["node_state"]) for n, r in got.items()} == {n: x[:2] for n, x in want.items()}
    assert {n: r["depth"] for n, r in got.items()} == {n: x[2] for n, x in want.items()}
    assert all("path" not in r for r in got.values())


def test_long_chain(spark):
    """Its paths would hold 4.5 * 10^10 nodes: a task gets a part of it."""
    df = spark.range(1, 300_001).select(F.col("id").alias("node"), F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"))
    got = h.hierarchy(df, paths=False)
    bad = got.where("root_id <> 1 or depth <> node - 1 or n_descendants <> 300000 - node or node_state <> 'tree' or not (parent <=> nullif(node - 1, 0))")
    assert got.count() == 300_000 and bad.count() == 0


def test_star(spark):
    df = spark.range(0, 50_000).select(F.col("id").alias("node"), F.when(F.col("id") > 0, F.lit(0)).alias("parent"))
    got = h.hierarchy(df, most=1_000)
    assert got.count() == 50_000 and got.where("node > 0 and (depth <> 1 or path <> array(0L, node) or n_descendants <> 0)").count() == 0
    assert got.where("node = 0").collect()[0]["n_descendants"] == 49_999


def test_dirty_nodes(spark):
    rows = [(1, None, "x"), (1, None, "y"), (2, 1, "x"), (2, 99, "x"), (3, 99, "x"), (None, 1, "x")]
    df = spark.createDataFrame(rows, "node long, parent long, depth string")
    got = {r["node"]: (r["root_id"], r["node_state"]) for r in h.hierarchy(df).collect()}
    assert got == {1: (1, "tree"), 2: (1, "tree"), 3: (3, "tree")}
    assert h.hierarchy(df.limit(0)).collect() == []


def test_category_nodes_follow_the_title_rule(spark):
    page = spark.createDataFrame([(1, 14, "Ort_in_A"), (2, 14, "Sache"), (2, 14, "Sache"), (3, 14, "ähnlich"), (4, 0, "Ort_in_A"), (None, 14, "x"), (5, 14, None)], "page_id long, page_namespace int, page_title string")
    links = spark.createDataFrame([(2, "Kategorie:ort in A_"), (3, " :Sache"), (4, "Sache"), (1, None), (1, "Unbekannt"), (3, "CATÉGORIE:_sache"), (None, "Sache")], "cl_from long, cl_to string")
    assert {(r["node"], r["parent"]) for r in h.category_nodes(page, links).collect()} == {(1, None), (2, 1), (3, 2), (5, None)}


def test_descendants(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 2)], "node long, parent long")
    assert {tuple(r) for r in h.descendants(h.hierarchy(df)).collect()} == {(1, 2, 1), (1, 3, 2), (2, 3, 1)}


@pytest.mark.parametrize("most, options", [(8_000_000, {}), (3, {"together": 5})])
def test_descendants_around_cycles(spark, most, options):
    parent = {1: None, 2: 1, 3: 2, 10: 11, 11: 12, 12: 13, 13: 10, 14: 12, 15: 14, 16: 10, 20: 20, 21: 20, 30: 31, 31: 30, 32: 31}
    parent |= {n: n + 1 for n in range(100, 111)} | {111: 100}
    want = {}
    for n in parent:
        at, steps = parent[n], 1
        while at is not None and (at, n) not in want:
            if at != n:
                want[at, n] = steps
            elif parent[n] == n or steps > 1:
                break
            at, steps = parent[at], steps + 1
    nodes = h.hierarchy(spark.createDataFrame(list(parent.items()), "node long, parent long"), most=most)
    got = [tuple(r) for r in h.descendants(nodes, **options).collect()]
    assert sorted(got) == sorted((*k, d) for k, d in want.items())
    assert {r["node"]: r["n_descendants"] for r in nodes.collect()} == {n: sum(a == n for a, _, _ in got) for n in parent}


def test_skewed_lookup_keeps_every_row(spark):
    left = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"), "id")
    right = spark.createDataFrame([("hot", 1), ("1", 2), (None, 3), ("none", 4)], "k string, v int")
    got = skew_lookup(left, right, ["k"], "left", least=100)
    assert sorted(got.columns) == ["id", "k", "v"] and got.count() == 9_000
    assert got.where("v = 1").count() == 3_000 and got.where("v = 2").count() == 1 and got.where("v > 2").count() == 0
    assert skew_lookup(left, right, ["k"], "inner", least=100).count() == 3_001

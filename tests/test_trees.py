"""Collapsed trees and placed sets against walks from node to node."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from cytoflux.operators import trees
from cytoflux.sources import scratch


def random_tree(seed, n):
    """Chains and branches; lengths count up."""
    rng = random.Random(seed)
    return [(k - 1 if rng.random() < 0.6 else rng.randrange(k), k, k) for k in range(1, n)]


def collapsed(edges, kept=()):
    up = {c: (p, n) for p, c, n in edges}
    children = Counter(p for p, _, _ in edges)
    gone = {p for p in children if children[p] == 1 and p in up and p not in kept}
    out = []
    for child in up:
        if child not in gone:
            p, n = up[child]
            while p in gone:
                p, n = up[p][0], n + up[p][1]
            out.append((p, child, n))
    return sorted(out)


def way_up(edges, node):
    up, out = {c: p for p, c, _ in edges}, [node]
    while out[-1] in up:
        out.append(up[out[-1]])
    return out


@pytest.mark.parametrize(("seed", "n"), [(1, 120), (2, 2), (3, 9)])
def test_trees(spark, seed, n):
    edges = random_tree(seed, n)
    df = spark.createDataFrame(edges + edges[:3], "parent int, child int, length int")
    got = trees.collapse_unary(df)
    assert got.columns == ["parent", "child", "length"] and sorted(map(tuple, got.collect())) == collapsed(edges)
    kept = spark.createDataFrame([(k,) for k in range(0, n, 5)], "node int")
    assert sorted(map(tuple, trees.collapse_unary(df, kept).collect())) == collapsed(edges, set(range(0, n, 5)))
    rng = random.Random(seed)
    sets = {s: {rng.randrange(n) for _ in range(rng.choice([1, 2, 3, 20]))} for s in range(12)}
    members = spark.createDataFrame([(s, m) for s, of in sets.items() for m in of] + [(0, min(sets[0])), (1, 10_000), (99, 10_000)], "set int, node int")
    under = Counter(a for k in range(n) for a in way_up(edges, k))
    want = {}
    for s, of in sets.items():
        shared = set.intersection(*(set(way_up(edges, m)) for m in of))
        node = max(shared, key=lambda k: len(way_up(edges, k)))
        want[s] = (node, len(of), under[node])
    assert {r.set: (r.node, r.n_members, r.n_under) for r in trees.place_sets(df, members).collect()} == want


def test_one_chain_and_no_tree(spark):
    chain = spark.createDataFrame([(k, k + 1, 1) for k in range(60)], "parent int, child int, length int")
    assert [tuple(r) for r in trees.collapse_unary(chain).collect()] == [(0, 60, 60)]
    assert trees.collapse_unary(chain.limit(0)).count() == 0 and trees.ancestors(chain.limit(0)).count() == 0
    two = spark.createDataFrame([(0, 1, 1), (10, 11, 1)], "parent int, child int, length int")
    members = spark.createDataFrame([("a", 1), ("a", 11), ("b", 11)], "set string, node int")
    assert [(r.set, r.node) for r in trees.place_sets(two, members).collect()] == [("b", 11)]


def test_tables_of_placing_have_a_row_a_node(spark, monkeypatch):
    """A row for each node and ancestor, or for each member and ancestor, would be 1,891 here."""
    edges = spark.createDataFrame([(k, k + 1, 1) for k in range(60)], "parent int, child int, length int")
    members = spark.createDataFrame([("all", k) for k in range(61)] + [("two", 40), ("two", 60), ("two", 60), (None, 3)], "set string, node int")
    sizes, write = [], scratch._write
    monkeypatch.setattr(scratch, "_write", lambda df: (out := write(df), sizes.append(out[0].count()))[0])
    assert {tuple(r) for r in trees.place_sets(edges, members).collect()} == {("all", 0, 61, 61), ("two", 40, 2, 21)}
    assert max(sizes) <= 61


def test_a_cycle_is_an_error(spark):
    with pytest.raises(ValueError, match="cycle"):
        trees.number_nodes(spark.createDataFrame([(0, 1), (1, 0)], "parent int, child int"))

"""Ward linkage against a plain version that merges one pair at a time."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest

from cytoflux.operators import linkage, metrics
from cytoflux.plans.queries import REGISTRY


def random_trace(seed, cells, samples, noise):
    rng = random.Random(seed)
    true = [rng.randrange(5) for _ in range(cells)]
    return [(s, c, rng.randrange(7) if rng.random() < noise else true[c]) for s in range(samples) for c in range(cells)]


def plain_tree(rows):
    """Heights of all merges and, for each k, the partition of the cells."""
    cells = sorted({c for _, c, _ in rows})
    at = {(s, c): k for s, c, k in rows}
    samples = sorted({s for s, _, _ in rows})
    d = {(a, b): (1 - sum(at[s, a] == at[s, b] for s in samples) / len(samples)) ** 2 for a, b in combinations(cells, 2)}
    groups, heights, partitions = {c: [c] for c in cells}, [], {len(cells): [[c] for c in cells]}
    get = lambda x, y: d[min(x, y), max(x, y)]
    while len(groups) > 1:
        a, b = min(combinations(sorted(groups), 2), key=lambda p: (round(d[p], 12), p))
        heights.append(d[a, b] ** 0.5)
        for w in groups:
            if w not in (a, b):
                na, nb, nw = len(groups[a]), len(groups[b]), len(groups[w])
                d[min(a, w), max(a, w)] = ((na + nw) * get(a, w) + (nb + nw) * get(b, w) - nw * d[a, b]) / (na + nb + nw)
        groups[a] = groups[a] + groups.pop(b)
        partitions[len(groups)] = [sorted(g) for g in groups.values()]
    return heights, partitions


def partition(rows):
    groups: dict = {}
    for cell, cluster in rows:
        groups.setdefault(cluster, []).append(cell)
    return sorted(sorted(g) for g in groups.values())


def frame(spark, rows):
    return spark.createDataFrame(rows, "sample int, cell int, cluster int")


@pytest.mark.parametrize(("cells", "samples", "noise"), [(200, 40, 0.3), (30, 7, 0.6)])
def test_tree(spark, cells, samples, noise):
    rows = random_trace(cells, cells, samples, noise)
    heights, partitions = plain_tree(rows)
    trace = frame(spark, rows)
    profiles, merges = linkage.linkage(trace)
    got = sorted(r.height for r in merges.collect())
    n_profiles = profiles.select("profile").distinct().count()
    assert len(got) == n_profiles - 1 and np.allclose(got, sorted(heights)[len(heights) - len(got) :], atol=1e-9)
    assert max(r["round"] for r in merges.collect()) < 40
    # Only cuts that no equal heights leave open.
    ordered = sorted(heights, reverse=True)
    ks = [k for k in range(2, 25) if ordered[k - 2] - ordered[k - 1] > 1e-9]
    cuts = linkage.cut_tree(profiles, merges, ks).collect()
    for k in ks:
        assert partition((r.cell, r.cluster) for r in cuts if r.k == k) == sorted(partitions[k])


def test_identical_cells_and_single_ones(spark):
    rows = [(s, c, c % 3 if s else 0) for s in range(4) for c in range(30)]
    profiles, merges = linkage.linkage(frame(spark, rows))
    assert {r.profile for r in profiles.collect()} == {0, 1, 2} and sorted(r.n for r in merges.collect()) == [20, 30]
    assert {r.k: r.n for r in linkage.cut_tree(profiles, merges, [1, 2, 3, 9]).groupBy("k").agg({"cluster": "approx_count_distinct"}).toDF("k", "n").collect()} == {1: 1, 2: 2, 3: 3, 9: 3}
    one = frame(spark, [(0, 5, 1), (1, 5, 2)])
    assert [(r.cell, r.cluster) for r in linkage.best_cut(one).collect()] == [(5, 5)]
    assert linkage.best_cut(one.limit(0)).count() == 0


def test_best_cut_has_the_greatest_mpear(spark):
    rows = random_trace(3, 60, 20, 0.15)
    trace = frame(spark, rows)
    best = linkage.best_cut(trace)
    first = best.first()
    _, partitions = plain_tree(rows)
    scores = {}
    for k in linkage.cut_range(trace):
        assigned = spark.createDataFrame([(c, g[0]) for g in partitions[k] for c in g], "cell int, cluster int")
        scores[k] = metrics.mpear(trace, assigned).first().mpear
    assert first.k == 5 and abs(first.mpear - max(scores.values())) < 1e-5 and scores[first.k] == max(scores.values())
    assert partition((r.cell, r.cluster) for r in best.collect()) == sorted(partitions[first.k])


def test_query(spark):
    rows = REGISTRY["ward_clusters"](spark, "/root/testdata/sf0.001").collect()
    assert rows and len({r.cell for r in rows}) == len(rows) and len({(r.k, r.mpear) for r in rows}) == 1 and len({r.cluster for r in rows}) == rows[0].k


def test_pairs_of_cells_are_not_shuffled(spark):
    rows = random_trace(5, 90, 4, 0.1)
    at = {(s, c): k for s, c, k in rows}
    both = {(a, b): sum(at[s, a] == at[s, b] for s in range(4)) for a in range(90) for b in range(a + 1, 90)}
    for width in (3, 1024):
        found = metrics.coclustering(frame(spark, rows), width)
        got = [tuple(r) for r in found.collect()]
        assert len(got) == len(set(got)) and set(got) == {(a, b, n / 4) for (a, b), n in both.items() if n}
    above = found._jdf.queryExecution().executedPlan().toString().split("Generate explode", 1)
    assert len(above) == 2 and "Exchange" not in above[0] and "Aggregate" not in above[0]
    assert metrics.coclustering(frame(spark, rows).limit(0)).count() == 0

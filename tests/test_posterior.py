"""Variates by their moments and quantiles, the sampler by enumeration, and runs that are stopped and taken up."""

from __future__ import annotations

import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoflux.functions import variates
from cytoflux.operators import metrics, posterior
from cytoflux.plans.params import Clustering
from cytoflux.sources import scratch


@pytest.mark.parametrize("shape", [0.05, 0.4, 1.0, 2.5, 40.0])
def test_gamma(spark, shape):
    x = np.array([r[0] for r in spark.range(20_000).select(F.exp(variates.log_gamma(F.lit(shape), 1, "id"))).collect()])
    assert abs(x.mean() - shape) < 5 * math.sqrt(shape / len(x)) and abs(x.var() / shape - 1) < 0.15 + 0.3 * (shape < 0.1)
    want = np.random.default_rng(0).gamma(shape, size=200_000)
    for q in (0.1, 0.5, 0.9):
        assert abs((x < np.quantile(want, q)).mean() - q) < 0.015


def test_beta_and_gumbel(spark):
    rows = spark.range(20_000).select(variates.beta(F.lit(2.0), F.lit(6.0), 3, "id").alias("b"), *[(F.log(F.lit(w)) + variates.gumbel(4, "id", F.lit(k))).alias(f"g{k}") for k, w in enumerate((1.0, 3.0, 6.0))])
    x = np.array([tuple(r) for r in rows.collect()])
    assert abs(x[:, 0].mean() - 0.25) < 0.006 and abs(x[:, 0].var() - 12 / (64 * 9)) < 0.001
    assert np.allclose(np.bincount(x[:, 1:].argmax(1), minlength=3) / len(x), [0.1, 0.3, 0.6], atol=0.02)


VALUES = [[1, 1, None], [1, 0, 1], [0, 0, 1], [0, 1, 0]]


def matrix(spark, values=VALUES):
    return spark.createDataFrame([(c, m, v) for c, row in enumerate(values) for m, v in enumerate(row)], "cell int, mut int, value int")


def exact(values, params, clusters):
    """Probability of each assignment: Dirichlet-multinomial times the profiles' integrals."""
    grid = (np.arange(2000) + 0.5) / 2000
    prior = grid ** (params.prior[0] - 1) * (1 - grid) ** (params.prior[1] - 1)
    prior /= prior.sum()
    one = grid * (1 - params.fn) + (1 - grid) * params.fp
    alpha, out = sum(params.dp_alpha) / clusters, {}
    for z in itertools.product(range(clusters), repeat=len(values)):
        p = math.prod(math.gamma(z.count(k) + alpha) / math.gamma(alpha) for k in range(clusters))
        for k in range(clusters):
            for m in range(len(values[0])):
                xs = [values[i][m] for i in range(len(values)) if z[i] == k and values[i][m] is not None]
                p *= (prior * math.prod((one if x else 1 - one for x in xs), start=np.ones_like(grid))).sum()
        out[z] = p
    total = sum(out.values())
    return {z: p / total for z, p in out.items()}


def test_posterior_matches_enumeration(spark):
    params = Clustering(steps=10, chains=1500, burn_in=0.0, dp_alpha=(0.5, 0.5), prior=(0.5, 0.5), fn=0.1, fp=0.05, seed=11)
    trace = posterior.sample_posterior(matrix(spark), params, clusters=2)
    last = trace.where("step = 10").groupBy("chain").agg(F.transform(F.sort_array(F.collect_list(F.struct("cell", "cluster"))), lambda x: x["cluster"]).alias("z")).collect()
    got, want = Counter(tuple(r.z) for r in last), exact(VALUES, params, 2)
    assert len(last) == 1500 and sum(got.values()) == 1500
    # Total variation of the 16 assignments: about 0.04 for as many independent draws.
    assert sum(abs(got[z] / 1500 - p) for z, p in want.items()) / 2 < 0.08
    for i, j in itertools.combinations(range(4), 2):
        assert abs(sum(n for z, n in got.items() if z[i] == z[j]) / 1500 - sum(p for z, p in want.items() if z[i] == z[j])) < 0.05


def rows(trace):
    return sorted(map(tuple, trace.select("chain", "step", "cell", "cluster").collect()))


def test_a_run_is_taken_up_and_plans_stay_small(spark, tmp_path):
    data = matrix(spark)
    params = Clustering(steps=6, chains=3, burn_in=0.34, seed=2)
    whole = posterior.sample_posterior(data, params, clusters=3, folder=str(tmp_path / "whole"))
    posterior.sample_posterior(data, Clustering(steps=3, chains=3, burn_in=0.34, seed=2), clusters=3, folder=str(tmp_path / "parts"))
    run = posterior.Run(spark, str(tmp_path / "parts"))
    assert run.last() == 3 and not run.has(1)
    (tmp_path / "parts" / "trace" / "step=3" / "_SUCCESS").unlink()  # a step that was not finished is drawn again
    assert run.last() == 2
    parts = posterior.sample_posterior(data, params, clusters=3, folder=str(tmp_path / "parts"))
    assert rows(parts) == rows(whole) and {r.step for r in whole.select("step").distinct().collect()} == {2, 3, 4, 5, 6}
    assert len(whole._jdf.queryExecution().optimizedPlan().toString()) < 2000


def test_stop_by_psrf_and_growth(spark, tmp_path):
    values = [[1, 1, 1, 0, 0, 0]] * 6 + [[0, 0, 0, 1, 1, 1]] * 6
    params = Clustering(steps=40, chains=3, burn_in=0.5, seed=3, psrf_cutoff=10.0, check_every=4)
    trace = posterior.sample_posterior(matrix(spark, values), params, clusters=2)
    assert trace.agg(F.max("step")).first()[0] == 4
    assert trace.agg(F.max("cluster")).first()[0] >= 0
    never = Clustering(steps=5, chains=2, burn_in=0.0, seed=3, psrf_cutoff=0.1, check_every=2)
    folder = str(tmp_path / "run")
    grown = posterior.sample_posterior(matrix(spark, values), never, clusters=2, folder=folder)
    assert grown.agg(F.max("step")).first()[0] == 5
    assert posterior.Run(spark, folder).state(5, "theta").select(F.size("theta")).first()[0] in (4, 8)
    assert posterior.sample_posterior(matrix(spark, values).limit(0), never, clusters=2).count() == 0


def broadcast_cells(df):
    """What is broadcast with a column of cells, as the plan has it."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    return [b for a, b in itertools.pairwise(lines) if "BroadcastExchange" in a and "cell#" in b]


def test_cells_are_never_broadcast(spark, tmp_path, monkeypatch):
    """Small files may hold many rows: a broadcast by their size had all values or clusters of cells in the driver."""
    found, write, cut = [], posterior.Run.write, scratch.Scratch.cut
    monkeypatch.setattr(posterior.Run, "write", lambda self, step, assigned, thetas: (found.extend(broadcast_cells(assigned) + broadcast_cells(thetas)), write(self, step, assigned, thetas)))
    monkeypatch.setattr(scratch.Scratch, "cut", lambda self, df: (found.extend(broadcast_cells(df)), cut(self, df))[1])
    trace = posterior.sample_posterior(matrix(spark), Clustering(steps=2, chains=2, burn_in=0.0, seed=2), clusters=20, folder=str(tmp_path / "run"))
    assert not found
    assert trace.count() == 16 and trace.agg(F.max("cluster")).first()[0] < 20


def test_samples_of_cells_are_not_broadcast(spark):
    samples = scratch.cut(spark.createDataFrame([(s, c, c % 2) for s in "ab" for c in range(4)], "sample string, cell int, cluster int"))
    shared = metrics.shared_pairs(samples, samples.withColumnRenamed("sample", "other"), ["sample"], ["other"])
    assert not broadcast_cells(shared) and "SortMergeJoin" in shared._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, shared.collect())) == [(s, o, 2.0) for s in "ab" for o in "ab"]


def test_queries_run_all_sweeps(spark, monkeypatch):
    """Both queries ran 10 sweeps of the 1000 that the defaults, and the method, ask for."""
    from cytoflux.plans import queries

    asked = []
    monkeypatch.setattr(posterior, "sample_posterior", lambda data, params=None, *a, **k: asked.append(params or Clustering()))
    queries.chains(spark, "/root/testdata/sf0.001")
    assert asked == [Clustering()] and Clustering().steps == 1000 and Clustering().psrf_cutoff is None


@pytest.mark.parametrize("scores", [1, 1_000_000])
def test_sweeps_in_one_job_and_in_many_draw_the_same(spark, tmp_path, monkeypatch, scores):
    from cytoflux.operators import sweeps

    values = [[1, 1, 1, 0, 0, None]] * 5 + [[0, 0, None, 1, 1, 1]] * 7
    params = Clustering(steps=7, chains=2, burn_in=0.0, seed=4, check_every=3)
    want = {tuple(r) for r in posterior.sample_posterior(matrix(spark, values), params, clusters=3).select("chain", "step", "cell", "cluster").collect()}
    monkeypatch.setattr(sweeps, "SCORES", scores)
    got = posterior.sample_posterior(matrix(spark, values), params, clusters=3)
    assert {tuple(r) for r in got.select("chain", "step", "cell", "cluster").collect()} == want and got.count() == 7 * 2 * 12
    # Beyond PROFILES numbers the run goes on with tables, from the steps that are there.
    monkeypatch.setattr(posterior, "PROFILES", 60)
    grown = posterior.sample_posterior(matrix(spark, values), Clustering(steps=7, chains=2, burn_in=0.0, seed=4, check_every=3), clusters=2)
    assert grown.count() == 7 * 2 * 12 and {r.step for r in grown.select("step").distinct().collect()} == set(range(1, 8))


@pytest.mark.parametrize(("table", "part"), [(1 << 22, 8192), (100, 5)])
def test_consensus_by_slices_of_samples(spark, monkeypatch, table, part):
    from cytoflux.operators import clustering

    rng = np.random.default_rng(6)
    rows = [(c, s, i, int(x)) for c in range(2) for s in range(9) for i, x in enumerate(np.where(rng.random(23) < 0.3, rng.integers(0, 4, 23), np.arange(23) % 4))]
    trace = spark.createDataFrame(rows, "chain int, step int, cell int, cluster int")
    samples = trace.select(F.concat_ws(":", "chain", "step").alias("sample"), "cell", "cluster")
    ids = {r.sample: k for k, r in enumerate(samples.select("sample").distinct().orderBy("sample").collect())}
    monkeypatch.setattr(clustering, "TABLE", table)
    monkeypatch.setattr(clustering, "CELLS", part)
    want = metrics.shared_pairs(samples, samples.withColumnRenamed("sample", "other"), ["sample"], ["other"]).groupBy("sample").agg(F.sum("pairs").alias("pairs"))
    assert {r.sample: r.pairs for r in clustering.together(samples, ids, 4).collect()} == {r.sample: r.pairs for r in want.collect()}
    found = sorted(map(tuple, clustering.consensus(trace).collect()))
    assert len(found) == 23 and found == sorted(map(tuple, clustering.consensus(trace.unionByName(trace.limit(0))).collect()))

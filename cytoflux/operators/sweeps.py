"""Sweeps of the sampler in `posterior` for few profiles: one job a sweep, or for as many cells as one task takes, one for many sweeps, with numpy inside the tasks.

Given the cells' clusters, true states are independent, and those of a cluster, mutation and value have one probability, so that only their
number matters: it is drawn from a binomial law. What a sweep needs of the cells are counts by cluster, mutation and value. The driver draws numbers of
states, profiles and weights from them (chains x clusters x mutations numbers each), tasks draw the cells' clusters. A cell's draw is a hash of its name and of
the sweep, so that a task that runs again draws the same; the trace is written for many sweeps at a time by drawing them again.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoflux.plans.params import Clustering
from cytoflux.sources.scratch import Scratch

LEAST, MOST = 1e-12, 1 - 1e-12
#: Scores that one task draws in a sweep, about; numbers that a task holds at a time; bytes of counts that reach the driver unsummed; bytes of sweeps that are written at a time; tasks that write the
#: trace of cells of one task.
SCORES, HELD, UNSUMMED, KEPT, WRITERS = 1_000_000, 2_000_000, 1 << 25, 1 << 25, 16
COUNTS = "at int, cells binary, ll binary, known binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix64's finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _present(theta: np.ndarray, params: Clustering) -> np.ndarray:
    return theta * (1 - params.fn) + (1 - theta) * params.fp


class Sweep:
    """What tasks need to draw the cells' clusters: logarithms of present and absent by chain, cluster and mutation, weights, and a key for each score."""

    def __init__(self, step: int, thetas: np.ndarray, weights: np.ndarray, params: Clustering):
        self.step, (self.chains, self.clusters, self.muts) = step, thetas.shape
        one = _present(thetas, params).reshape(-1, self.muts)
        self.logs, self.weights = np.concatenate([np.log(one), np.log(1 - one)], axis=1).T.copy(), weights.reshape(-1)
        parts = np.random.SeedSequence([params.seed & (2**64 - 1), step, 1]).generate_state(2, np.uint64)
        # By chain and place, whatever the number of clusters.
        chain, k = np.divmod(np.arange(weights.size, dtype=np.uint64), np.uint64(self.clusters))
        self.keys = _mixed(_mixed(parts[0] + chain) + parts[1] + k)

    def draw(self, names: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and log-likelihood by cell and chain. names: a number a cell; known: how often it has each mutation present, and then absent."""
        lls = known @ self.logs
        u = ((_mixed(names[:, None] + self.keys[None, :]) >> np.uint64(12)) + 0.5) * 2.0**-52
        scores = (lls + self.weights - np.log(-np.log(u))).reshape(len(names), self.chains, self.clusters)
        chosen = scores.argmax(axis=2)
        return chosen, np.take_along_axis(lls.reshape(scores.shape), chosen[:, :, None], axis=2)[:, :, 0]


def _blocks(batches: Iterator[pa.RecordBatch], kind: str, width: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Cells, their numbers and their values, so many at a time that width numbers of each fit."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows := max(1, HELD // width)):
            part = batch.slice(at, rows)
            known = np.frombuffer(b"".join(part.column("known").to_pylist()), kind).reshape(part.num_rows, -1).astype(float)
            yield part.column("cell"), part.column("name").to_numpy().view(np.uint64), known


def tally(sweep: Sweep, blocks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells and values (present, then absent) by chain and cluster, log-likelihoods by chain."""
    cells, ll, known = np.zeros(sweep.weights.size, np.int64), np.zeros(sweep.chains), np.zeros((sweep.weights.size, 2 * sweep.muts), np.int64)
    for _, names, values in blocks:
        chosen, lls = sweep.draw(names, values)
        own = np.zeros((len(names), sweep.weights.size))
        np.put_along_axis(own, chosen + np.arange(sweep.chains) * sweep.clusters, 1.0, axis=1)
        cells += own.sum(axis=0).astype(np.int64)
        ll += lls.sum(axis=0)
        known += (own.T @ values).astype(np.int64)
    return cells, known, ll


def _parted(known: np.ndarray) -> np.ndarray:
    return np.stack(np.split(known, 2, axis=2))


class Cells:
    """The matrix as a row a cell, for profiles of all its mutations."""

    def __init__(self, data: DataFrame, muts: list, params: Clustering, clusters: int, scratch: Scratch):
        self.spark, self.data, self.muts, self.params = data.sparkSession, data, muts, params
        self.mut_type, self.cell_type = data.schema["mut"].dataType, data.schema["cell"].dataType
        places = self.spark.createDataFrame(list(zip(muts, range(len(muts)), strict=True)), f"mut {self.mut_type.simpleString()}, at int")
        one = F.col("value") == 1
        self.counted = data.join(F.broadcast(places), "mut").groupBy("cell", "at").agg(F.count_if(one).alias("ones"), F.count_if(~one).alias("zeros"))
        cells, most = data.agg(F.countDistinct("cell")).first()[0], self.counted.agg(F.max(F.greatest("ones", "zeros"))).first()[0]
        self.tasks = max(1, -(-cells * max(params.chains * clusters, len(muts)) // SCORES))
        self.kind, m = "u1" if most < 256 else "i4", len(muts)
        kind = self.kind

        def packed(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, rows := max(1, HELD // (2 * m))):
                    part = batch.slice(at, rows)
                    lists = part.column("values")
                    row, x = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy()), lists.flatten()
                    known, place = np.zeros((part.num_rows, 2 * m), kind), x.field("at").to_numpy()
                    known[row, place], known[row, place + m] = x.field("ones").to_numpy(), x.field("zeros").to_numpy()
                    yield pa.RecordBatch.from_arrays([part.column("cell"), part.column("name"), pa.array([r.tobytes() for r in known], pa.binary())], names=["cell", "name", "known"])

        rows = self.counted.repartition(self.tasks, "cell").groupBy("cell").agg(F.collect_list(F.struct("at", "ones", "zeros")).alias("values"))
        rows = rows.select("cell", F.xxhash64(F.lit("cell"), "cell").alias("name"), "values")
        self.rows = scratch.cut(rows.mapInArrow(packed, f"cell {self.cell_type.simpleString()}, name long, known binary"))

    def counts(self, sweep: Sweep) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the clusters that a sweep draws: cells (chain, cluster), values (present and absent; chain, cluster, mutation) and log-likelihoods (chain)."""
        kind, width, m = self.kind, sweep.weights.size + 2 * sweep.muts, sweep.muts

        def drawn(batches):
            cells, known, ll = tally(sweep, _blocks(batches, kind, width))
            # A row a chain, so that chains can be summed apart.
            each = lambda x: [r.tobytes() for r in x.reshape(sweep.chains, -1)]
            yield pa.RecordBatch.from_arrays([pa.array(range(sweep.chains), pa.int32()), *[pa.array(each(x), pa.binary()) for x in (cells, ll, known)]], names=["at", "cells", "ll", "known"])

        def summed(table):
            add = lambda name, kind: sum(np.frombuffer(x, kind) for x in table.column(name).to_pylist()).tobytes()
            return pa.table({"at": pa.array([table.column("at")[0].as_py()], pa.int32()), "cells": pa.array([add("cells", np.int64)], pa.binary()), "ll": pa.array([add("ll", float)], pa.binary()), "known": pa.array([add("known", np.int64)], pa.binary())})

        found = self.rows.mapInArrow(drawn, COUNTS)
        if self.tasks > 1 and self.tasks * sweep.logs.nbytes > UNSUMMED:
            found = found.groupBy("at").applyInArrow(summed, COUNTS)
        cells, ll, known = np.zeros((sweep.chains, sweep.clusters), np.int64), np.zeros(sweep.chains), np.zeros((sweep.chains, sweep.clusters, 2 * m), np.int64)
        # In a fixed order, as sums of likelihoods are rounded.
        for r in sorted(found.collect(), key=lambda r: (r["at"], bytes(r["ll"]))):
            cells[r["at"]] += np.frombuffer(r["cells"], np.int64)
            ll[r["at"]] += np.frombuffer(r["ll"])[0]
            known[r["at"]] += np.frombuffer(r["known"], np.int64).reshape(sweep.clusters, 2 * m)
        return cells, _parted(known), ll

    def advance(self, step: int, cells: np.ndarray, known: np.ndarray, thetas: np.ndarray, clusters: int, n: int) -> tuple[list[Sweep], list[np.ndarray], np.ndarray, np.ndarray, list[np.ndarray]]:
        """n sweeps behind a step: the sweeps, their profiles, the last one's counts, all log-likelihoods. Cells of one task are swept in one job."""
        params, kind = self.params, self.kind

        def swept(counts):
            drawn, profiles, lls, state = [], [], [], (cells, known)
            for s in range(step + 1, step + n + 1):
                theta, sweep = following(s, *state, profiles[-1] if profiles else thetas, params, clusters)
                *state, ll = counts(sweep)
                drawn.append(sweep)
                profiles.append(theta)
                lls.append(ll)
            return drawn, profiles, *state, lls

        def whole(batches):
            blocks = list(_blocks(batches, kind, clusters * params.chains + 2 * thetas.shape[2]))

            def counts(sweep):
                cells, known, ll = tally(sweep, blocks)
                return cells.reshape(sweep.chains, -1), _parted(known.reshape(sweep.chains, sweep.clusters, -1)), ll

            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(swept(counts))], pa.binary())], names=["x"])

        if self.tasks > 1:
            return swept(self.counts)
        return pickle.loads(self.rows.coalesce(1).mapInArrow(whole, "x binary").first()["x"])

    def trace(self, sweeps: list[Sweep]) -> DataFrame:
        """step, chain, cell, cluster, ll of all these sweeps."""
        kind, width = self.kind, max(s.weights.size + 2 * s.muts for s in sweeps)

        def drawn(batches):
            for cells, names, values in _blocks(batches, kind, width):
                for s in sweeps:
                    chosen, lls = s.draw(names, values)
                    chain, cell = (x.reshape(-1) for x in np.indices((s.chains, len(names))))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(chain), s.step, np.int32)), pa.array(chain.astype(np.int32)), cells.take(pa.array(cell)), pa.array(chosen.T.reshape(-1).astype(np.int32)), pa.array(lls.T.reshape(-1))], names=["step", "chain", "cell", "cluster", "ll"])

        found = self.rows.mapInArrow(drawn, f"step int, chain int, cell {self.cell_type.simpleString()}, cluster int, ll double")
        # A file a step takes longer than the steps of few cells.
        return found if self.tasks > 1 else found.repartition(WRITERS, "step")

    def counts_of(self, assigned: DataFrame, clusters: int) -> tuple[np.ndarray, np.ndarray]:
        """`counts` of given clusters (chain, cell, cluster)."""
        cells, known = np.zeros((self.params.chains, clusters), np.int64), np.zeros((2, self.params.chains, clusters, len(self.muts)), np.int64)
        for r in assigned.groupBy("chain", "cluster").agg(F.count("*").alias("n")).collect():
            cells[r.chain, r.cluster] = r.n
        met = self.counted.join(assigned.select("chain", "cell", "cluster").hint("merge"), "cell")
        for r in met.groupBy("chain", "cluster", "at").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")).collect():
            known[:, r.chain, r.cluster, r["at"]] = r.ones, r.zeros
        return cells, known

    def profiles(self, thetas: DataFrame, clusters: int) -> np.ndarray:
        """chain, cluster, mutation; clusters that the table doesn't have are at the prior's mean."""
        a, b = self.params.prior
        out, at = np.full((self.params.chains, clusters, len(self.muts)), a / (a + b)), {m: i for i, m in enumerate(self.muts)}
        for r in thetas.select("chain", "mut", "theta").collect():
            out[r.chain, : len(r.theta), at[r.mut]] = r.theta
        return out

    def table(self, thetas: np.ndarray) -> DataFrame:
        rows = [(c, m, thetas[c, :, i].tolist()) for c in range(len(thetas)) for i, m in enumerate(self.muts)]
        return self.spark.createDataFrame(rows, f"chain int, mut {self.mut_type.simpleString()}, theta array<double>")


def following(step: int, cells: np.ndarray, known: np.ndarray, thetas: np.ndarray, params: Clustering, clusters: int) -> tuple[np.ndarray, Sweep]:
    """Profiles and weights of the step, drawn from the counts and profiles of the step before it; clusters that it didn't have are empty."""
    a, b = params.prior
    more = clusters - thetas.shape[1]
    if more > 0:
        thetas, cells = np.pad(thetas, ((0, 0), (0, more), (0, 0)), constant_values=a / (a + b)), np.pad(cells, ((0, 0), (0, more)))
        known = np.pad(known, ((0, 0), (0, 0), (0, more), (0, 0)))
    rng = np.random.Generator(np.random.PCG64(np.random.SeedSequence([params.seed & (2**64 - 1), step, 0])))
    one = _present(thetas, params)
    there = lambda n, p: rng.binomial(n, np.clip(p, 0, 1))
    ones = there(known[0], thetas * (1 - params.fn) / one) + there(known[1], thetas * params.fn / (1 - one))
    thetas = np.clip(rng.beta(ones + a, known.sum(axis=0) - ones + b), LEAST, MOST)
    shape = cells + max(sum(params.dp_alpha), 1e-3) / clusters
    # The logarithm of a gamma variate, by one of a greater shape, keeps tiny ones apart from 0.
    weights = np.log(rng.gamma(shape + 1)) + np.log1p(-rng.random(shape.shape)) / shape
    return thetas, Sweep(step, thetas, weights, params)


def few_muts(data: DataFrame, most: int) -> list | None:
    """The mutations in order, if there are any and `most` at most."""
    muts = [r["mut"] for r in data.select("mut").distinct().limit(most + 1).collect()]
    return sorted(muts) if 0 < len(muts) <= most else None


def scores_table(spark: SparkSession, lls: dict[int, np.ndarray], burn_in: int) -> DataFrame:
    """chain, step (from 0 behind the burn-in), value of the log-likelihoods by step."""
    rows = [(c, s - burn_in, round(float(x), 6)) for s, ll in lls.items() if s >= burn_in for c, x in enumerate(ll)]
    return spark.createDataFrame(rows, "chain int, step long, value double")

"""Posterior samples of a mixture of Bernoulli profiles, by blocked Gibbs sweeps over tables.

Cells (data: cell, mut, value) belong to clusters with a profile each: theta, the probability that a mutation is there. A
present one is read as absent with probability fn, an absent one as present with fp. Weights have a symmetric Dirichlet
prior of alpha / clusters each, which nears a Dirichlet process as `clusters` grows; profiles have a beta prior. A sweep draws, one
after the other, each from its full conditional:

    true state of each value | profile of its cell's cluster, value      Bernoulli
    theta of each cluster and mutation | the states in it                beta
    weights | sizes of the clusters                                      Dirichlet, from gamma variates
    cluster of each cell | weights, profiles, values                     categorical, by Gumbel noise

Values are packed, one row a cell and slice of mutations, and a sweep unpacks them in the task that reads them: what it shuffles are clusters of cells,
counts by cluster and likelihoods of cells, each combined before. Chains are a column. Every sweep appends one partition to the trace, a table in the shared
folder, so that a plan never grows with the steps, and a run that was stopped goes on from its last whole step. It ends when the chains agree (PSRF).

Where chains times clusters times mutations are up to PROFILES numbers, `sweeps` draws the same laws in one job a sweep; the tables below are for more of them.

Files of a few bits a value say nothing about the memory that their rows take, so joins don't leave it to Spark to broadcast by the size of a file: profiles are
broadcast up to PROFILES numbers, counted before, weights (one a chain and cluster) always, cells never.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoflux.functions.variates import beta, gumbel, log_gamma, uniform
from cytoflux.operators import sweeps
from cytoflux.operators.metrics import lugsail_psrf
from cytoflux.plans.params import Clustering
from cytoflux.sources.scratch import Scratch, shared_dir

LEAST, MOST = 1e-12, 1 - 1e-12
#: Values that a packed row holds, about; values that one task packs; clusters whose likelihoods one row holds; numbers of profiles that are broadcast.
SLICE, TASK, WIDTH, PROFILES = 1024, 250_000, 16, 500_000


def _present(theta: Column, params: Clustering) -> Column:
    """Probability that a value is 1."""
    return theta * (1 - params.fn) + (1 - theta) * params.fp


def _clipped(theta: Column) -> Column:
    return F.least(F.greatest(theta, F.lit(LEAST)), F.lit(MOST))


def pack(data: DataFrame) -> DataFrame:
    """cell, slice (of its mutations, by hash), values: mut and value of each. data: cell, mut, value, without unknown values."""
    muts, values = data.select(F.countDistinct("mut"), F.count("*")).first()
    sliced = data.withColumn("slice", F.pmod(F.xxhash64("mut"), F.lit(max(1, -(-muts // SLICE)))).cast("int"))
    # The files are small and what a sweep makes of them is not, so that their number is fixed here.
    return sliced.repartition(max(1, -(-values // TASK)), "cell", "slice").groupBy("cell", "slice").agg(F.collect_list(F.struct("mut", "value")).alias("values"))


def _unpacked(packed: DataFrame, *keys: str) -> DataFrame:
    return packed.select(*keys, F.explode("values").alias("x")).select(*keys, "x.mut", "x.value")


def start(packed: DataFrame, params: Clustering, clusters: int) -> tuple[DataFrame, DataFrame]:
    """Clusters drawn evenly (chain, cell, cluster) and profiles drawn from their prior (chain, mut, theta: an array)."""
    chain = F.explode(F.sequence(F.lit(0), F.lit(params.chains - 1))).alias("chain")
    cells, muts = packed.select("cell").distinct().select(chain, "cell"), _unpacked(packed).select("mut").distinct().select(chain, "mut")
    return cells.withColumn("cluster", F.floor(uniform(params.seed, F.lit("start"), "chain", "cell") * clusters).cast("int")), muts.withColumn("theta", F.array().cast("array<double>"))


def _by_cluster(counted: DataFrame, clusters: int, *keys: str) -> DataFrame:
    """keys, n: an array with a struct of the counts for each cluster, 0 for those without a row. counted: keys, cluster and counts."""
    names = [c for c in counted.columns if c not in (*keys, "cluster")]
    none = F.struct(*[F.lit(0).cast("long").alias(c) for c in names])
    filled = counted.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("cluster", F.struct(*names)))).alias("counts"))  # at most a row a cluster
    return filled.select(*keys, F.transform(F.sequence(F.lit(0), F.lit(clusters - 1)), lambda k: F.coalesce(F.try_element_at("counts", k), none)).alias("n"))


def sweep(packed: DataFrame, assigned: DataFrame, thetas: DataFrame, params: Clustering, clusters: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """New clusters (chain, cell, cluster, ll: log-likelihood of the cell in it) and profiles. Clusters that the profiles don't have yet are empty.

    assigned and thetas are a state of the run with its step, a column, so that all sweeps run the same compiled code.
    """
    a, b = params.prior
    at = F.col("step") + 1
    # As many rows as there are chains and mutations, and `clusters` numbers each.
    few = thetas.count() * clusters <= PROFILES
    near = (lambda df: F.broadcast(df)) if few else (lambda df: df.hint("merge"))
    placed = packed.join(assigned.select("chain", "cell", "cluster").hint("merge"), "cell")
    known = _unpacked(placed, "chain", "cell", "cluster").join(near(thetas), ["chain", "mut"])
    theta = F.coalesce(F.get("theta", F.col("cluster")), F.lit(a / (a + b)))
    there = F.when(F.col("value") == 1, theta * (1 - params.fn) / _present(theta, params)).otherwise(theta * params.fn / (1 - _present(theta, params)))
    drawn = known.select("step", "chain", "mut", "cluster", (uniform(params.seed, F.lit("state"), at, "chain", "cell", "mut") < there).alias("there"))
    counted = drawn.groupBy("step", "chain", "mut", "cluster").agg(F.count_if("there").alias("ones"), F.count_if(~F.col("there")).alias("zeros"))
    # Clusters without cells draw from the prior.
    draw = lambda n, k: _clipped(beta(n["ones"] + a, n["zeros"] + b, params.seed, F.lit("theta"), at, F.col("chain"), F.col("mut"), k))
    thetas = scratch.cut(_by_cluster(counted, clusters, "step", "chain", "mut").select("chain", "mut", F.transform("n", draw).alias("theta")))

    # Logarithms once a profile, WIDTH clusters a row, so that a value adds to all of them at once and plans don't grow with the clusters.
    part = F.explode(F.sequence(F.lit(0), F.lit((clusters - 1) // WIDTH))).alias("part")
    own = thetas.select("chain", "mut", part, "theta").withColumn("theta", F.slice("theta", F.col("part") * WIDTH + 1, F.lit(WIDTH)))
    logs = scratch.cut(own.select("chain", "mut", "part", F.transform("theta", lambda t: F.log(_present(t, params))).alias("on"), F.transform("theta", lambda t: F.log(1 - _present(t, params))).alias("off")))
    each = _unpacked(packed, "cell").join(near(logs), "mut").select("chain", "cell", "part", F.when(F.col("value") == 1, F.col("on")).otherwise(F.col("off")).alias("log"))
    lls = each.groupBy("chain", "cell", "part").agg(*[F.sum(F.get("log", F.lit(i))).alias(f"ll{i}") for i in range(WIDTH)])
    alpha = max(sum(params.dp_alpha), 1e-3) / clusters
    sizes = _by_cluster(assigned.groupBy("step", "chain", "cluster").agg(F.count("*").alias("cells")), clusters, "step", "chain")
    weights = sizes.select("step", "chain", F.transform("n", lambda n, k: log_gamma(n["cells"] + alpha, params.seed, F.lit("weight"), at, F.col("chain"), k)).alias("weights"))
    weights = scratch.cut(weights.select("step", "chain", part, "weights").withColumn("weights", F.slice("weights", F.col("part") * WIDTH + 1, F.lit(WIDTH))))

    def scored(i: int) -> Column:
        k = F.col("part") * WIDTH + i
        return F.struct((F.col(f"ll{i}") + F.get("weights", F.lit(i)) + gumbel(params.seed, F.lit("cluster"), at, F.col("chain"), F.col("cell"), k)).alias("score"), k.alias("k"), F.col(f"ll{i}").alias("ll"))

    # Where the clusters end within a row, scores are null, the least of all.
    best = lls.join(F.broadcast(weights), ["chain", "part"]).select("chain", "cell", F.greatest(*map(scored, range(WIDTH))).alias("x"))
    chosen = best.groupBy("chain", "cell").agg(F.max("x").alias("x"))
    return chosen.select("chain", "cell", F.col("x.k").alias("cluster"), F.col("x.ll").alias("ll")), thetas


def chain_scores(trace: DataFrame) -> DataFrame:
    """chain, step, ll, n_clusters."""
    return trace.groupBy("chain", "step").agg(F.sum("ll").alias("ll"), F.countDistinct("cluster").alias("n_clusters"))


def psrf(trace: DataFrame, burn_in: int) -> float | None:
    """Of the chains' log-likelihoods behind the burn-in; null where they don't vary."""
    scores = chain_scores(trace.where(F.col("step") >= burn_in))
    return lugsail_psrf(scores.select("chain", (F.col("step") - burn_in).alias("step"), F.round("ll", 6).alias("value"))).first()["psrf"]


class Run:
    """A run's folder: `trace/step=n` and `theta/step=n`, whole if they end with _SUCCESS."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.files = spark.sparkContext._jvm.org.apache.hadoop.fs

    def _path(self, name: str):
        path = self.files.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def has(self, step: int) -> bool:
        return all(fs.exists(p) for fs, p in (self._path(f"{t}/step={step}/_SUCCESS") for t in ("trace", "theta")))

    def last(self) -> int:
        """The last whole step, -1 for none: steps are written one after the other."""
        fs, path = self._path("trace")
        steps = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(path) if "step=" in s.getPath().getName()] if fs.exists(path) else []
        return max((s for s in steps if self.has(s)), default=-1)

    def write(self, step: int, assigned: DataFrame, thetas: DataFrame) -> None:
        for name, df in (("theta", thetas), ("trace", assigned)):
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.folder}/{name}/step={step}")

    def append(self, trace: DataFrame, thetas: dict[int, DataFrame], steps: list[int]) -> None:
        """Several steps at once: the trace of all of them, and the profiles of the last ones."""
        for step, df in thetas.items():
            df.coalesce(1).write.mode("overwrite").option("compression", "zstd").parquet(f"{self.folder}/theta/step={step}")
        trace.write.mode("append").partitionBy("step").option("compression", "zstd").parquet(f"{self.folder}/trace")
        for step in steps:
            fs, path = self._path(f"trace/step={step}/_SUCCESS")
            fs.create(path, True).close()

    def forget(self, step: int) -> None:
        fs, path = self._path(f"theta/step={step}")
        fs.delete(path, True)

    def forget_after(self, step: int) -> None:
        """Steps that were not finished."""
        for name in ("trace", "theta"):
            fs, path = self._path(name)
            for s in fs.listStatus(path) if fs.exists(path) else []:
                if s.getPath().getName().startswith("step=") and int(s.getPath().getName().split("=")[1]) > step:
                    fs.delete(s.getPath(), True)

    def state(self, step: int, name: str) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.folder}/{name}").parquet(f"{self.folder}/{name}/step={step}")

    def trace(self) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.folder}/trace").parquet(f"{self.folder}/trace").select("chain", "step", "cell", "cluster", "ll")


def sample_posterior(data: DataFrame, params: Clustering | None = None, clusters: int = 16, folder: str | None = None) -> DataFrame:
    """trace: chain, step, cell, cluster, ll (of the cell) of the kept steps, a table that the run's steps were appended to.

    data: cell, mut, value (1, 0; null is unknown and doesn't count; cells and mutations without a known value have no row). Every check_every
    steps the run ends if the PSRF of the chains' log-likelihoods behind the burn-in is below psrf_cutoff (if there is one), else after params.steps; where
    a chain fills all clusters, their number is doubled. folder: a run in this shared folder is taken up behind its last whole step; the steps behind the burn-in share of all its
    steps are kept. The same data, parameters and seed give the same trace, taken up or not.
    """
    params = params or Clustering()
    spark = data.sparkSession
    run = Run(spark, folder or f"{shared_dir(spark)}/posterior-{uuid.uuid4().hex}")
    known = data.where(F.col("value").isNotNull()).select("cell", "mut", "value")
    with Scratch(spark) as scratch:
        done = run.last()
        known = scratch.cut(known)
        muts = sweeps.few_muts(known, PROFILES // (params.chains * clusters))
        if muts:
            done, over = _few_profiles(run, known, muts, params, clusters, scratch)
            if over:
                return _kept(run, done, params)
        packed = scratch.cut(pack(known))
        if done < 0:
            assigned, thetas = start(packed, params, clusters)
            run.write(0, assigned.withColumn("ll", F.lit(None).cast("double")), thetas)
            done = 0
        while done < params.steps and not _ends(run, done, params):
            assigned, thetas = run.state(done, "trace"), run.state(done, "theta")
            width = thetas.agg(F.max(F.size("theta"))).first()[0] or clusters
            if done and done % params.check_every == 0:
                filled = assigned.groupBy("chain").agg(F.countDistinct("cluster").alias("k")).agg(F.max("k")).first()[0] or 0
                width = 2 * width if filled >= width else width
            with Scratch(spark) as step:
                run.write(done + 1, *sweep(packed, assigned, thetas, params, max(width, clusters), step))
            run.forget(done - 1)
            done += 1
    return _kept(run, done, params)


def _kept(run: Run, done: int, params: Clustering) -> DataFrame:
    return run.trace().where((F.col("step") > 0) & (F.col("step") >= int(done * params.burn_in)))


def _few_profiles(run: Run, known: DataFrame, muts: list, params: Clustering, clusters: int, scratch: Scratch) -> tuple[int, bool]:
    """Runs with profiles on the driver, while they are few; the last step, and whether the run is over. Steps are written up to check_every at a time."""
    cells = sweeps.Cells(known, muts, params, clusters, scratch)
    done = run.last()
    if done < 0:
        chain = F.explode(F.sequence(F.lit(0), F.lit(params.chains - 1))).alias("chain")
        drawn = F.floor(uniform(params.seed, F.lit("start"), "chain", "cell") * clusters).cast("int")
        assigned = cells.rows.select(chain, "cell").withColumns({"cluster": drawn, "ll": F.lit(None).cast("double")})
        run.write(0, assigned, cells.table(np.zeros((params.chains, 0, len(muts)))))
        done = 0
    run.forget_after(done)
    assigned, table = run.state(done, "trace"), run.state(done, "theta")
    width = max(clusters, table.agg(F.max(F.size("theta"))).first()[0] or 0)
    few = lambda: width * params.chains * len(muts) <= PROFILES
    if not few():
        return done, False
    sizes, values = cells.counts_of(assigned, width)
    thetas, lls = cells.profiles(table, width), {}
    if done:
        for r in chain_scores(run.trace().where(f"step > 0 AND step <= {done}")).collect():
            lls.setdefault(r.step, np.zeros(params.chains))[r.chain] = r.ll

    def ends() -> bool:
        if params.psrf_cutoff is None or done == 0 or done % params.check_every:
            return False
        burn_in = max(int(done * params.burn_in), 1)
        value = lugsail_psrf(sweeps.scores_table(run.spark, lls, burn_in)).first()["psrf"]
        return value is not None and value < params.psrf_cutoff

    while done < params.steps and not ends():
        if done and done % params.check_every == 0 and (sizes > 0).sum(axis=1).max() >= width:
            width *= 2
            if not few():
                return done, False
        n = min(params.steps - done, params.check_every - done % params.check_every, max(1, sweeps.KEPT // (16 * width * params.chains * len(muts))))
        drawn, profiles, sizes, values, new = cells.advance(done, sizes, values, thetas, width, n)
        lls |= {s.step: ll for s, ll in zip(drawn, new, strict=True)}
        done, thetas = done + n, profiles[-1]
        run.append(cells.trace(drawn), {s.step: cells.table(t) for s, t in zip(drawn[-2:], profiles[-2:], strict=True)}, [s.step for s in drawn])
        for step in range(max(0, drawn[0].step - 2), done - 1):
            run.forget(step)
    return done, True


def _ends(run: Run, done: int, params: Clustering) -> bool:
    if params.psrf_cutoff is None or done == 0 or done % params.check_every:
        return False
    value = psrf(run.trace().where(f"step > 0 AND step <= {done}"), max(int(done * params.burn_in), 1))
    return value is not None and value < params.psrf_cutoff

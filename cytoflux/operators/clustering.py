"""Summaries of sampled clusterings: a consensus of the samples, and genotypes of its clusters."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cytoflux.operators.metrics import shared_pairs
from cytoflux.plans.params import Clustering
from cytoflux.sources.scratch import Scratch


#: Cells whose labels a task counts at a time; numbers of its table of contingency counts; meets of a cell's labels that one task counts, about.
CELLS, TABLE, MEETS = 8192, 1 << 22, 50_000_000


def together(samples: DataFrame, ids: dict, clusters: int) -> DataFrame:
    """sample, pairs: over all samples, the pairs of cells that are in one cluster both in this one and in that one.

    From contingency counts between samples: cells times samples squared, never pairs of cells. Labels are packed by slices of samples; a task has
    a pair of slices, and adds up the counts of their samples over the cells, CELLS at a time. samples: sample, cell, cluster (from 0, below
    `clusters`), a row for each sample and cell. ids: of the samples, numbered from 0.
    """
    spark, n = samples.sparkSession, len(ids)
    width = max(1, min(n, int(TABLE**0.5) // clusters))
    slices, kind = -(-n // width), "u1" if clusters < 256 else "i4"
    numbered = samples.join(F.broadcast(spark.createDataFrame(list(ids.items()), "sample string, id int")), "sample")
    cells = samples.select("cell").distinct().count()
    parts = max(1, -(-cells // CELLS))
    own = numbered.select(F.pmod(F.xxhash64("cell"), F.lit(parts)).cast("int").alias("part"), F.floor(F.col("id") / width).cast("int").alias("slice"), "cell", (F.col("id") % width).alias("at"), "cluster")
    lists = own.repartition(max(1, -(-parts * slices // 4)), "part", "slice").groupBy("part", "slice", "cell").agg(F.sort_array(F.collect_list(F.struct("at", "cluster"))).alias("x"))
    # Every sample has every cell, so that all slices of a part have its cells in one order.
    lists = lists.sortWithinPartitions("part", "slice", "cell").select("part", "slice", F.transform("x", lambda x: x["cluster"]).alias("x"))

    def packed(batches):
        key, held = None, []
        flush = lambda: pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([np.concatenate(held).tobytes()], pa.binary())], names=["part", "slice", "labels"])
        for batch in batches:
            part, at, x = batch.column("part").to_numpy(), batch.column("slice").to_numpy(), batch.column("x")
            cuts = [0, *(np.flatnonzero((np.diff(part) != 0) | (np.diff(at) != 0)) + 1), len(part)] if len(part) else [0]
            for a, b in itertools.pairwise(cuts):
                if key is not None and key != (part[a], at[a]):
                    yield flush()
                    held = []
                key = (part[a], at[a])
                held.append(x.slice(a, b - a).flatten().to_numpy().astype(kind))
        if held:
            yield flush()

    def met(rows):
        """(number of the sample, pairs) of a task's pairs of slices, which come by (a, b)."""
        key, table = None, None

        def flush():
            pairs = (table * (table - 1) // 2).sum(axis=2)
            yield from ((key[0] * width + i, int(p)) for i, p in enumerate(pairs.sum(axis=1)))
            yield from ((key[1] * width + j, int(p)) for j, p in enumerate(pairs.sum(axis=0)) if key[0] != key[1])

        for a, b, x, y in rows:
            if key != (a, b):
                if key is not None:
                    yield from flush()
                key, sizes = (a, b), [min(width, n - s * width) for s in (a, b)]
                table, places = np.zeros((*sizes, clusters * clusters), np.int64), np.arange(sizes[1], dtype=np.int32) * clusters * clusters
            x, y = (np.frombuffer(v, kind).reshape(-1, m).astype(np.int32) for v, m in zip((x, y), sizes, strict=True))
            for i in range(sizes[0]):
                table[i] += np.bincount((y + places + x[:, i, None] * clusters).reshape(-1), minlength=table[i].size).reshape(table[i].shape)
        if key is not None:
            yield from flush()

    with Scratch(spark) as scratch:
        labels, tasks = scratch.cut(lists.mapInArrow(packed, "part int, slice int, labels binary")), min(slices * (slices + 1) // 2, -(-cells * n * n // MEETS))
        x = labels.select("part", F.col("slice").alias("a"), F.col("labels").alias("x"), F.explode(F.sequence(F.col("slice"), F.lit(slices - 1))).alias("b"))
        both = x.join(labels.select("part", F.col("slice").alias("b"), F.col("labels").alias("y")).hint("merge"), ["part", "b"])
        rows = both.select("a", "b", "x", "y").repartition(max(1, tasks), "a", "b").sortWithinPartitions("a", "b")
        sums: dict[int, int] = {}
        for i, p in rows.rdd.mapPartitions(met).collect():
            sums[i] = sums.get(i, 0) + p
    names = {i: s for s, i in ids.items()}
    return spark.createDataFrame([(names[i], p) for i, p in sorted(sums.items())], "sample string, pairs long")


def consensus(trace: DataFrame) -> DataFrame:
    """cell, cluster: the kept clustering with the greatest expected adjusted Rand index over all kept ones.

    From contingency counts between kept clusterings: cells times clusterings squared, never pairs of cells.
    """
    samples = trace.select(F.concat_ws(":", "chain", "step").alias("sample"), "cell", "cluster")
    sizes = samples.groupBy("sample", "cluster").agg(F.count("*").alias("n"))
    own = sizes.groupBy("sample").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("i"), F.sum("n").alias("rows"), F.max("cluster").alias("most"), F.min("cluster").alias("least"))
    own = trace.sparkSession.createDataFrame(own.collect(), own.schema)
    cells, n = samples.agg(F.countDistinct("cell")).first()[0], own.count()
    all_i, most, least, fewest, greatest = own.agg(F.sum("i"), F.max("most"), F.min("least"), F.min("rows"), F.max("rows")).first()
    s = F.lit((all_i or 0.0) / max(n, 1))
    expected = s * F.col("i") / F.lit(max(cells * (cells - 1) / 2, 1))
    score = (F.col("si") - expected) / F.nullif((s + F.col("i")) / 2 - expected, F.lit(0.0))
    if n and fewest == greatest == cells and least >= 0 and most < TABLE**0.5:
        pairs = together(samples, {r["sample"]: k for k, r in enumerate(own.select("sample").orderBy("sample").collect())}, int(most) + 1)
    else:  # any trace, slowly
        pairs = shared_pairs(samples, samples.withColumnRenamed("sample", "other"), ["sample"], ["other"]).groupBy("sample").agg(F.sum("pairs").alias("pairs"))
    sums = pairs.select("sample", (F.col("pairs") / n).alias("si")).join(own, "sample")
    best = sums.select("sample", score.alias("score")).orderBy(F.desc_nulls_last("score"), "sample").limit(1)
    return samples.join(best.select("sample"), "sample", "left_semi").select("cell", "cluster")


def cluster_genotypes(data: DataFrame, assigned: DataFrame) -> DataFrame:
    """cluster, mut, theta: the share of known values that are 1, and called: whether that is one half or more."""
    known = data.where(F.col("value").isNotNull()).join(assigned, "cell")
    return known.groupBy("cluster", "mut").agg(F.avg(F.col("value").cast("double")).alias("theta")).withColumn("called", (F.col("theta") >= 0.5).cast("int"))


def trace_profiles(data: DataFrame, trace: DataFrame, prior: tuple[float, float] = Clustering.prior) -> DataFrame:
    """sample, cluster, mut, theta: every kept clustering's mean profiles. data: cell, mut, value; trace: sample, cell, cluster."""
    a, b = prior
    known = data.where(F.col("value").isNotNull()).join(trace.select("sample", "cell", "cluster"), "cell")
    return known.groupBy("sample", "cluster", "mut").agg(((F.count_if(F.col("value") == 1) + a) / (F.count("*") + a + b)).alias("theta"))


def averaged_genotypes(trace: DataFrame, thetas: DataFrame, assigned: DataFrame) -> DataFrame:
    """cluster, mut, theta, called: the profiles of a consensus (cell, cluster), averaged over the samples of a trace.

    A cluster is averaged over the samples that have exactly its cells in one cluster; if there are none, over those
    that have all its cells in one, whoever else is there; else over all samples, weighted by where its cells are. Only
    sizes of clusters and of their meets are needed. Every sample has all cells. thetas: sample, cluster, mut, theta.
    """
    own = assigned.select("cell", F.col("cluster").alias("k"))
    sizes = own.groupBy("k").agg(F.count("*").alias("n_k"))
    theirs = trace.groupBy("sample", "cluster").agg(F.count("*").alias("n_c"))
    met = trace.join(own, "cell").groupBy("k", "sample", "cluster").agg(F.count("*").alias("n")).join(sizes, "k").join(theirs, ["sample", "cluster"])
    rank = F.when((F.col("n") == F.col("n_k")) & (F.col("n") == F.col("n_c")), 0).when(F.col("n") == F.col("n_k"), 1).otherwise(2)
    met = met.withColumn("rank", rank)
    best = met.groupBy("k").agg(F.min("rank").alias("best"))
    used = met.join(best, "k").where(F.col("rank").eqNullSafe(F.col("best"))).select("k", "sample", "cluster", "n")
    out = used.join(thetas, ["sample", "cluster"]).groupBy(F.col("k").alias("cluster"), "mut").agg((F.sum(F.col("theta") * F.col("n")) / F.sum("n")).alias("theta"))
    return out.withColumn("called", (F.round("theta", 9) >= 0.5).cast("int"))  # whatever the order of the sum


def newest(trace: DataFrame) -> DataFrame:
    """The last step of each chain."""
    return trace.withColumn("last", F.max("step").over(Window.partitionBy("chain"))).where("step = last").drop("last")

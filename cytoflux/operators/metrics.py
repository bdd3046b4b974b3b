"""Comparisons of clusterings and genotypes, and summaries of chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cytoflux.sources.scratch import cut

EPSILON = 1e-9
#: Possible pairs of cells that one task pairs.
TASK_PAIRS = 4_000_000


def _pairs(n: Column) -> Column:
    return n * (n - 1) / 2


def contingency(assigned: DataFrame, pred: str = "pred", true: str = "true") -> DataFrame:
    return assigned.groupBy(F.col(pred).alias("p"), F.col(true).alias("t")).agg(F.count("*").alias("n"))


def _margins(assigned: DataFrame, pred: str, true: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    cells = contingency(assigned, pred, true)
    return cells, cells.groupBy("p").agg(F.sum("n").alias("n")), cells.groupBy("t").agg(F.sum("n").alias("n"))


def adjusted_rand(assigned: DataFrame, pred: str = "pred", true: str = "true") -> DataFrame:
    """One row: ari. Clusterings that leave nothing to chance (all one, or all apart) agree fully."""
    cells, rows, columns = _margins(assigned, pred, true)
    sums = cells.agg(F.sum(_pairs(F.col("n"))).alias("both"), F.sum("n").alias("total"))
    sums = sums.crossJoin(rows.agg(F.sum(_pairs(F.col("n"))).alias("a"))).crossJoin(columns.agg(F.sum(_pairs(F.col("n"))).alias("b")))
    expected = F.col("a") * F.col("b") / _pairs(F.col("total"))
    best = (F.col("a") + F.col("b")) / 2
    return sums.select(F.when(best == expected, 1.0).otherwise(F.round((F.col("both") - expected) / (best - expected), 6)).alias("ari"))


def v_measure(assigned: DataFrame, pred: str = "pred", true: str = "true") -> DataFrame:
    """One row: homogeneity, completeness, v_measure."""
    cells, rows, columns = _margins(assigned, pred, true)
    entropy = lambda df, name: df.withColumn("total", F.sum("n").over(Window.partitionBy())).agg((-F.sum(F.col("n") / F.col("total") * F.log(F.col("n") / F.col("total")))).alias(name))
    h = entropy(cells, "both").crossJoin(entropy(rows, "hp")).crossJoin(entropy(columns, "ht"))
    zero = 1e-12
    hom = F.when(F.col("ht") < zero, 1.0).otherwise(1 - (F.col("both") - F.col("hp")) / F.col("ht"))
    com = F.when(F.col("hp") < zero, 1.0).otherwise(1 - (F.col("both") - F.col("ht")) / F.col("hp"))
    h = h.select(hom.alias("h"), com.alias("c"))
    v = F.when(F.col("h") + F.col("c") < zero, 0.0).otherwise(2 * F.col("h") * F.col("c") / (F.col("h") + F.col("c")))
    return h.select(F.round("h", 6).alias("homogeneity"), F.round("c", 6).alias("completeness"), F.round(v, 6).alias("v_measure"))


def hamming(pred: DataFrame, true: DataFrame, either_way: bool = False) -> DataFrame:
    """One row: n_compared, n_differ, distance. Both: cell, mut, value (null: unknown, not compared).

    either_way: for square matrices whose cells and mutations share their names; true is also compared with cells and
    mutations swapped, and the lesser distance counts.
    """
    if either_way:
        swapped = true.select(F.col("mut").alias("cell"), F.col("cell").alias("mut"), "value")
        both = hamming(pred, true).unionByName(hamming(pred, swapped))
        return both.agg(F.min_by(F.struct(*both.columns), F.coalesce("distance", F.lit(2.0))).alias("least")).select("least.*")
    joined = pred.select("cell", "mut", F.col("value").alias("p")).join(true.select("cell", "mut", F.col("value").alias("t")), ["cell", "mut"]).where("p IS NOT NULL AND t IS NOT NULL")
    return joined.agg(F.count("*").alias("n_compared"), F.count_if(F.col("p") != F.col("t")).alias("n_differ")).withColumn("distance", F.round(F.col("n_differ") / F.nullif(F.col("n_compared"), F.lit(0)), 6))


def error_rates(pred: DataFrame, data: DataFrame) -> DataFrame:
    """One row: fn and fp of the data (0/1) against the genotypes."""
    joined = pred.select("cell", "mut", F.col("value").alias("g")).join(data.select("cell", "mut", F.col("value").alias("x")), ["cell", "mut"]).where("g IS NOT NULL AND x IS NOT NULL")
    rate = lambda g, x: F.round((F.count_if((F.col("g") == g) & (F.col("x") == x)) + EPSILON) / (F.count_if(F.col("g") == g) + EPSILON), 6)
    return joined.agg(rate(1, 0).alias("fn"), rate(0, 1).alias("fp"))


def coclustering(trace: DataFrame, width: int = 1024) -> DataFrame:
    """cell_a < cell_b and similarity: the share of samples in which both are in one cluster. trace: sample, cell, cluster.

    Cells with the same way through the samples are one profile. Profiles meet pair by pair and are counted; their cells, in slices of about
    `width`, are then paired without another shuffle of the pairs, which are the result asked for: cells squared.
    """
    n = trace.select("sample").distinct().count()
    step = F.struct("sample", "cluster")
    by_cell = trace.where("cell IS NOT NULL AND sample IS NOT NULL AND cluster IS NOT NULL").groupBy("cell").agg(F.sort_array(F.collect_list(step)).alias("way"))
    cells = cut(by_cell.select("cell", F.sha2(F.to_json("way"), 256).alias("digest"), "way"))
    profiles = cut(cells.groupBy("digest").agg(F.min("cell").alias("profile"), F.first("way").alias("way"), F.count("*").alias("n")))
    ways = profiles.select("profile", F.explode("way").alias("x")).select("profile", "x.sample", "x.cluster")
    met = ways.withColumnRenamed("profile", "p").join(ways.withColumnRenamed("profile", "q"), ["sample", "cluster"]).where("p <= q").groupBy("p", "q").agg(F.count("*").alias("both"))
    # Every pair of profiles with its slices of cells; tasks get about as many pairs of cells each.
    sized = cells.join(profiles.select("digest", "profile", (F.floor((F.col("n") - 1) / width) + 1).cast("int").alias("slices")), "digest")
    sliced = sized.groupBy("profile", F.pmod(F.xxhash64("cell"), "slices").cast("int").alias("slice")).agg(F.collect_list("cell").alias("cells"))
    sliced = cut(sliced)
    side = lambda key, name: sliced.select(F.col("profile").alias(key), F.col("slice").alias(f"{name}_slice"), F.col("cells").alias(name))
    total = profiles.agg(F.sum("n")).first()[0] or 0
    tasks = max(1, -(-total * total // TASK_PAIRS))
    slices = met.join(sliced.select(F.col("profile").alias("p"), F.col("slice").alias("a_slice")), "p").join(sliced.select(F.col("profile").alias("q"), F.col("slice").alias("b_slice")), "q")
    dealt = slices.where("p < q OR a_slice <= b_slice").repartition(tasks, "p", "q", "a_slice", "b_slice")
    paired = dealt.join(side("p", "a"), ["p", "a_slice"]).join(side("q", "b"), ["q", "b_slice"])
    paired = paired.select("p", "q", "a_slice", "b_slice", "both", F.explode("a").alias("a"), "b").select("p", "q", "a_slice", "b_slice", "both", "a", F.explode("b").alias("b"))
    # Inside one slice each pair stands there both ways.
    once = paired.where("a <> b").where("p < q OR a_slice < b_slice OR a < b")
    return once.select(F.least("a", "b").alias("cell_a"), F.greatest("a", "b").alias("cell_b"), F.round(F.col("both") / F.lit(max(n, 1)), 6).alias("similarity"))


def shared_pairs(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str]) -> DataFrame:
    """Per left_keys and right_keys how many pairs of cells are in one cluster on both sides: from contingency counts,
    without pairs. left: left_keys, cell, cluster; right: right_keys, cell, cluster."""
    # Merged: a trace's files are a few bits a cell, whatever its rows take in memory, so that Spark would broadcast them by their size.
    both = left.withColumnRenamed("cluster", "l").join(right.withColumnRenamed("cluster", "r").hint("merge"), "cell")
    return both.groupBy(*left_keys, *right_keys, "l", "r").agg(F.count("*").alias("n")).groupBy(*left_keys, *right_keys).agg(F.sum(_pairs(F.col("n"))).alias("pairs"))


def mpear(trace: DataFrame, assigned: DataFrame) -> DataFrame:
    """One row: the expected adjusted Rand index of a clustering (cell, cluster) over the samples of a trace (sample, cell, cluster).

    A pair's similarity is the share of samples with both in one cluster; only sums over pairs are needed, which
    follow from the sizes of clusters and of their meets. Every sample has the cells of the clustering.
    """
    within = lambda df, *by: df.groupBy(*by, "cluster").agg(F.count("*").alias("n")).agg(F.sum(_pairs(F.col("n"))).alias("x"))
    n = trace.select(F.countDistinct("sample").alias("n"))
    s = within(trace, "sample").select(F.col("x").alias("s"))
    si = shared_pairs(trace, assigned, ["sample"], []).agg(F.sum("pairs").alias("si"))
    i = within(assigned).select(F.col("x").alias("i")).crossJoin(assigned.agg(_pairs(F.count("*")).alias("all")))
    sums = n.crossJoin(s).crossJoin(si).crossJoin(i).select((F.col("si") / F.col("n")).alias("si"), (F.col("s") / F.col("n")).alias("s"), "i", "all")
    expected = F.col("s") * F.col("i") / F.col("all")
    return sums.select(F.round((F.col("si") - expected) / F.nullif((F.col("s") + F.col("i")) / 2 - expected, F.lit(0.0)), 6).alias("mpear"))


def batch_variance(trace: DataFrame, size: Column, name: str) -> DataFrame:
    """Per chain the batch-means variance estimate with batches of `size` steps. trace: chain, step (from 0), value, n, mean."""
    batches = trace.withColumn("b", size).withColumn("batch", F.floor(F.col("step") / F.col("b"))).where((F.col("batch") + 1) * F.col("b") <= F.col("n"))
    means = batches.groupBy("chain", "batch").agg(F.avg("value").alias("m"), F.first("b").alias("b"), F.first("mean").alias("mean"))
    return means.groupBy("chain").agg((F.first("b") / F.greatest(F.count("*") - 1, F.lit(1)) * F.sum(F.pow(F.col("m") - F.col("mean"), 2))).alias(name))


def lugsail_psrf(trace: DataFrame) -> DataFrame:
    """One row: n_chains, n, psrf with the lugsail batch-means estimator (batches of sqrt(n) and a third of that)."""
    own = Window.partitionBy("chain")
    t = trace.withColumns({"n": F.count("*").over(own), "mean": F.avg("value").over(own)})
    b = F.floor(F.sqrt("n"))
    third = F.greatest(F.floor(b / 3), F.lit(1))
    per = t.groupBy("chain").agg(F.count("*").alias("n"), F.var_samp("value").alias("s2"), F.avg("value").alias("mean"))
    both = per.join(batch_variance(t, b, "big"), "chain").join(batch_variance(t, third, "small"), "chain")
    tau = both.agg(F.count("*").alias("n_chains"), F.min("n").alias("n"), F.avg("s2").alias("s2"), F.avg(2 * F.col("big") - F.col("small")).alias("tau"))
    sigma = (F.col("n") - 1) / F.col("n") * F.col("s2") + F.col("tau") / F.col("n")
    return tau.select("n_chains", "n", F.round(F.sqrt(sigma / F.col("s2")), 6).alias("psrf"))


def best_steps(trace: DataFrame) -> DataFrame:
    """The best step by likelihood and by posterior, over all chains: ml_chain, ml_step, map_chain, map_step. trace: chain, step, ll, lpost."""
    at = F.struct("chain", "step")
    best = lambda score: F.max_by(at, F.struct(score, -F.col("chain"), -F.col("step")))
    out = trace.agg(best("ll").alias("ml"), best("lpost").alias("map"))
    return out.select(F.col("ml.chain").alias("ml_chain"), F.col("ml.step").alias("ml_step"), F.col("map.chain").alias("map_chain"), F.col("map.step").alias("map_step"))


def latent_summary(trace: DataFrame, *columns: str) -> DataFrame:
    return trace.agg(*[f(c).alias(f"{c}_{n}") for c in columns for f, n in ((F.avg, "mean"), (F.stddev_pop, "sd"))])


def cluster_order(assigned: DataFrame) -> DataFrame:
    """cell, cluster, size and place: clusters by size, the largest first, cells by name within."""
    sized = assigned.withColumn("size", F.count("*").over(Window.partitionBy("cluster")))
    clusters = sized.groupBy("cluster").agg(F.first("size").alias("size")).withColumn("nth", F.row_number().over(Window.orderBy(F.desc("size"), "cluster")))
    inside = F.row_number().over(Window.partitionBy("cluster").orderBy("cell"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = clusters.select("cluster", before.alias("before"))
    return sized.join(offsets, "cluster").select("cell", "cluster", "size", (F.col("before") + inside).alias("place"))

"""Ward linkage of cells by how often they share a cluster, and the cut of its tree with the best MPEAR.

The distance of two cells is one less the share of a trace's samples that have both in one cluster. Cells that no sample
parts are one profile from the start, with their number as its size. Then, round by round, every cluster finds its nearest
one, and all pairs that are each other's nearest merge at once; the Lance-Williams update of all distances is
one aggregation of the table of pairs. Ward's distances never shrink by a merge, so that the tree is the one that merging
the closest pair at a time gives, in as many rounds as the tree is deep rather than as it has merges. Pairs stay a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoflux.operators.metrics import shared_pairs
from cytoflux.sources.scratch import Scratch, cut


def cell_profiles(trace: DataFrame) -> DataFrame:
    """cell and profile: the least cell that all samples have in the same cluster. trace: sample, cell, cluster."""
    by_cell = trace.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("sample", "cluster"))).alias("way"))
    # Two digests stand for the way through the samples.
    keyed = by_cell.select("cell", F.sha2(F.to_json("way"), 256).alias("way"))
    return keyed.join(keyed.groupBy("way").agg(F.min("cell").alias("profile")), "way").select("cell", "profile")


def profile_distances(trace: DataFrame, profiles: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Sizes (id, n) of the profiles, and their pairs (a < b) with Ward's squared distance."""
    n_samples = trace.select("sample").distinct().count()
    sizes = scratch.cut(profiles.groupBy(F.col("profile").alias("id")).agg(F.count("*").alias("n")))
    ways = scratch.cut(trace.join(sizes.select(F.col("id").alias("cell")), "cell", "left_semi").select("sample", F.col("cell").alias("id"), "cluster"))
    met = ways.withColumnRenamed("id", "a").join(ways.withColumnRenamed("id", "b"), ["sample", "cluster"]).where("a < b").groupBy("a", "b").agg(F.count("*").alias("both"))
    # Every pair of profiles has a distance, most often 1: the matrix that linkage is about.
    left, right = sizes.select(F.col("id").alias("a"), F.col("n").alias("na")), sizes.select(F.col("id").alias("b"), F.col("n").alias("nb"))
    pairs = left.join(right, F.col("a") < F.col("b")).join(met, ["a", "b"], "left")
    apart = 1 - F.coalesce("both", F.lit(0)) / F.lit(float(max(n_samples, 1)))
    return sizes, pairs.select("a", "b", (2.0 * F.col("na") * F.col("nb") / (F.col("na") + F.col("nb")) * apart * apart).alias("d"))


def ward(sizes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The tree, one row a merge: id (the cluster that goes), into (the one that stays), height, n (cells of both), round.

    sizes: id, n; pairs: a < b and d, the squared distance, of all pairs. Ties go to the lesser ids.
    """
    merges = None
    with Scratch(sizes.sparkSession) as kept:
        sizes, pairs, round_ = kept.cut(sizes), kept.cut(pairs), 0
        while not pairs.isEmpty():
            now = Scratch(sizes.sparkSession)
            of = F.struct("d", "a", "b")
            ends = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("own"), of.alias("to")), F.struct(F.col("b").alias("own"), of.alias("to")))).alias("x"))
            # The least pair of each cluster; a pair that is the least of both its clusters merges.
            nearest = ends.groupBy("x.own").agg(F.min("x.to").alias("to"))
            chosen = nearest.groupBy("to").agg(F.count("*").alias("ends")).where("ends = 2").select("to.a", "to.b", "to.d")
            chosen = chosen.join(sizes.select(F.col("id").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("id").alias("b"), F.col("n").alias("nb")), "b")
            chosen = kept.cut(chosen.select("a", "b", "d", (F.col("na") + F.col("nb")).alias("n"), F.lit(round_).alias("round")))
            merges = chosen if merges is None else kept.cut(merges.unionByName(chosen))
            # Where each cluster goes: own size, new id and size, squared height of the merge (0 for none).
            gone = chosen.select(F.explode(F.array("a", "b")).alias("id"), F.col("a").alias("new"), F.col("n").alias("new_n"), F.col("d").alias("h"))
            moved = now.cut(sizes.join(gone, "id", "left").select("id", "n", F.coalesce("new", "id").alias("new"), F.coalesce("new_n", "n").alias("new_n"), F.coalesce("h", F.lit(0.0)).alias("h")))
            side = lambda k: moved.select(F.col("id").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in ("n", "new", "new_n", "h")])
            both = pairs.join(side("a"), "a").join(side("b"), "b").where("new_a <> new_b")
            total = F.col("new_n_a") + F.col("new_n_b")
            share = (F.col("n_a") + F.col("n_b")) / total * F.col("d")
            minus = (F.col("new_n_b") * F.col("h_a") + F.col("new_n_a") * F.col("h_b")) / total
            updated = both.groupBy(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).agg(F.sum(share).alias("s"), F.first(minus).alias("m"))
            new_pairs = kept.cut(updated.select("a", "b", (F.col("s") - F.col("m")).alias("d")))
            new_sizes = kept.cut(moved.groupBy(F.col("new").alias("id")).agg(F.first("new_n").alias("n")))
            now.drop()
            sizes, pairs, round_ = new_sizes, new_pairs, round_ + 1
        if merges is None:
            kind = dict(sizes.dtypes)["id"]
            return sizes.sparkSession.createDataFrame([], f"id {kind}, into {kind}, height double, n long, round int")
        return cut(merges.select(F.col("b").alias("id"), F.col("a").alias("into"), F.sqrt(F.greatest("d", F.lit(0.0))).alias("height"), "n", "round"))


def linkage(trace: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The profiles of the cells (cell, profile) and their tree (see `ward`). trace: sample, cell, cluster; every sample has all cells."""
    with Scratch(trace.sparkSession) as scratch:
        trace = scratch.cut(trace.select("sample", "cell", "cluster"))
        profiles = cut(cell_profiles(trace))
        sizes, pairs = profile_distances(trace, profiles, scratch)
        return profiles, ward(sizes, pairs)


def cut_tree(profiles: DataFrame, merges: DataFrame, ks: list[int]) -> DataFrame:
    """k, cell, cluster (its least profile) for each number of clusters k: all but the k - 1 highest merges take place.

    A k above the number of profiles leaves each of them alone.
    """
    # Merges in order of their heights, one row a profile; nothing wider is ordered in one task.
    ranked = merges.withColumn("below", F.row_number().over(Window.orderBy(F.desc("height"), F.desc("round"), F.desc("id"))))
    links = ranked.select("id", "into", "below")
    wanted = F.explode(F.array(*map(F.lit, ks)))
    roots = profiles.select(F.col("profile").alias("id")).distinct().withColumn("k", wanted).join(links, "id", "left")
    step = cut(roots.select("k", "id", F.when(F.col("below") >= F.col("k"), F.col("into")).otherwise(F.col("id")).alias("up")))
    while True:  # pointers to the ancestor twice as far
        above = step.select("k", F.col("id").alias("up"), F.col("up").alias("upper"))
        jumped = cut(step.join(above, ["k", "up"]).select("k", "id", F.col("upper").alias("up"), (F.col("upper") != F.col("up")).alias("moved")))
        step = jumped.select("k", "id", "up")
        if jumped.where("moved").isEmpty():
            return profiles.join(step.withColumnRenamed("id", "profile"), "profile").select("k", "cell", F.col("up").alias("cluster"))


def mpear_by_cut(trace: DataFrame, cuts: DataFrame) -> DataFrame:
    """k and mpear: the expected adjusted Rand index of each cut (k, cell, cluster) over the trace, from contingency counts."""
    within = lambda df, *by: df.groupBy(*by, "cluster").agg(F.sum(F.lit(1)).alias("n"))
    pairs = lambda n: F.col(n) * (F.col(n) - 1) / 2
    n_samples, cells = trace.agg(F.countDistinct("sample"), F.countDistinct("cell")).first()
    s = (within(trace, "sample").agg(F.sum(pairs("n"))).first()[0] or 0.0) / max(n_samples, 1)
    shared = shared_pairs(trace, cuts, ["sample"], ["k"]).groupBy("k").agg((F.sum("pairs") / max(n_samples, 1)).alias("si"))
    own = within(cuts, "k").groupBy("k").agg(F.sum(pairs("n")).alias("i"))
    expected: Column = F.lit(s) * F.col("i") / F.lit(max(cells * (cells - 1) / 2, 1))
    return own.join(shared, "k").select("k", ((F.col("si") - expected) / F.nullif((F.lit(s) + F.col("i")) / 2 - expected, F.lit(0.0))).alias("mpear"))


def cut_range(trace: DataFrame) -> list[int]:
    """Numbers of clusters to try: from a fifth of the samples' mean number of clusters of over two cells (2 at least) to two and a half times it."""
    sizes = trace.groupBy("sample", "cluster").agg(F.count("*").alias("n"))
    mean = sizes.groupBy("sample").agg(F.count_if(F.col("n") > 2).alias("k")).agg(F.avg("k")).first()[0] or 0.0
    cells = trace.select("cell").distinct().count()
    first, last = max(2.0, mean * 0.2), min(mean * 2.5, float(cells))
    return [int(first) + i for i in range(max(0, -int(-(last - first) // 1)))]


def best_cut(trace: DataFrame) -> DataFrame:
    """cell, cluster, k and mpear: of the cuts of the Ward tree in `cut_range`, the one with the greatest MPEAR (ties: the fewest clusters).

    Where the range is empty (samples without clusters of over two cells), the tree is cut into two.
    """
    profiles, merges = linkage(trace)
    with Scratch(trace.sparkSession) as scratch:
        trace = scratch.cut(trace.select("sample", "cell", "cluster"))
        cuts = cut(cut_tree(profiles, merges, cut_range(trace) or [2]))
        best = mpear_by_cut(trace, cuts).orderBy(F.desc_nulls_last("mpear"), "k").first()
        if best is None:
            return cuts.select("cell", "cluster", "k", F.lit(None).cast("double").alias("mpear"))
        return cuts.where(F.col("k") == best["k"]).select("cell", "cluster", "k", F.lit(best["mpear"]).alias("mpear"))

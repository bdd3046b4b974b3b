"""Trees as tables of edges: nodes without a branch are collapsed, and sets of nodes are placed, by pointers that double their reach.

Every node points at its parent; a round lets all of them point where their targets do, so that a tree of depth d takes
log2(d) rounds, each one join of the table with itself, or a few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cytoflux.sources.scratch import Scratch, cut

#: Slices of a node's children: one window sorts one of them.
SLICES = 1024


def collapse_unary(edges: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """parent, child and length of the tree without the nodes that have exactly one child, the root (which has no parent) excepted.

    Lengths along a collapsed path add up (null counts as 0). kept: nodes (node) that stay, as something hangs on them. edges: parent, child, length;
    a child has one parent. Repeated edges are one; an empty table gives no rows.
    """
    with Scratch(edges.sparkSession) as scratch:
        edges = scratch.cut(edges.groupBy("child").agg(F.min("parent").alias("parent"), F.coalesce(F.min("length"), F.lit(0)).alias("length")))
        unary = edges.groupBy("parent").agg(F.count("*").alias("n")).where("n = 1").select(F.col("parent").alias("node")).join(edges.select(F.col("child").alias("node")), "node", "left_semi")
        unary = scratch.cut(unary if kept is None else unary.join(kept.select("node"), "node", "left_anti"))
        gone = unary.select(F.col("node").alias("child"), F.lit(True).alias("gone"))
        rows = scratch.cut(edges.join(gone, "child", "left").withColumn("gone", F.coalesce("gone", F.lit(False))))
        while True:
            # Rows whose target goes away move on to that one's target, with its length.
            over = rows.where("gone").select(F.col("child").alias("parent"), F.col("parent").alias("upper"), F.col("length").alias("more"))
            if rows.join(over, "parent", "left_semi").isEmpty():
                return cut(rows.where("NOT gone").select("parent", "child", "length"))
            moved = rows.join(over, "parent", "left")
            rows = scratch.cut(moved.select(F.coalesce("upper", "parent").alias("parent"), "child", (F.col("length") + F.coalesce("more", F.lit(0))).alias("length"), "gone"))


def ancestors(edges: DataFrame) -> DataFrame:
    """node, ancestor and distance of every node and everything above it, itself included: as many rows as the depths add up to."""
    with Scratch(edges.sparkSession) as scratch:
        one = scratch.cut(edges.select(F.col("child").alias("node"), F.col("parent").alias("ancestor"), F.lit(1).alias("distance")).distinct())
        reach, known = 1, one
        while True:
            # All pairs up to `reach` apart, and the farthest ones joined with them: up to twice as far.
            far = known.where(F.col("distance") == reach).select("node", F.col("ancestor").alias("mid"))
            more = scratch.cut(far.join(known.select(F.col("node").alias("mid"), "ancestor", F.col("distance").alias("rest")), "mid").select("node", "ancestor", (F.col("rest") + reach).alias("distance")))
            if more.isEmpty():
                break
            known, reach = scratch.cut(known.unionByName(more)), 2 * reach
        nodes = edges.select(F.col("child").alias("node")).union(edges.select("parent")).distinct()
        return cut(known.unionByName(nodes.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("distance"))))


def number_nodes(edges: DataFrame) -> DataFrame:
    """node, root (of its tree), place (from 0: a node comes before all under it, and those follow without a gap), above (the parent's place, null at a root)
    and n_under (nodes under it, itself included): one row a node, whatever the depth.
    """
    with Scratch(edges.sparkSession) as scratch:
        up = scratch.cut(edges.where("child IS NOT NULL AND parent IS NOT NULL").groupBy("child").agg(F.min("parent").alias("parent")))
        nodes = up.select(F.col("child").alias("node")).union(up.select("parent")).distinct()
        nodes = scratch.cut(nodes.join(up.select(F.col("child").alias("node"), "parent").hint("merge"), "node", "left"))
        most, reach = nodes.count(), 1
        # n_under: of the nodes less than `reach` below; what is below the one `reach` above adds to it.
        sized = scratch.cut(nodes.select("node", F.col("parent").alias("at"), F.lit(1).cast("long").alias("n_under")))
        while not sized.where("at IS NOT NULL").isEmpty():
            if reach > most:
                raise ValueError("edges with a cycle")
            more = sized.where("at IS NOT NULL").groupBy(F.col("at").alias("node")).agg(F.sum("n_under").alias("more"))
            over = sized.select(F.col("node").alias("at"), F.col("at").alias("upper"))
            moved = sized.join(over.hint("merge"), "at", "left").join(more.hint("merge"), "node", "left")
            sized = scratch.cut(moved.select("node", F.col("upper").alias("at"), (F.col("n_under") + F.coalesce("more", F.lit(0))).alias("n_under")))
            reach *= 2
        # Places behind the parent's: brothers and sisters in order of slices and names, so that no window holds more than a slice of them.
        own = scratch.cut(nodes.join(sized.select("node", "n_under").hint("merge"), "node").withColumn("slice", F.pmod(F.xxhash64("node"), F.lit(SLICES))))
        below = own.where("parent IS NOT NULL")
        slices = below.groupBy("parent", "slice").agg(F.sum("n_under").alias("n"))
        first = lambda n, window: F.coalesce(F.sum(n).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        slices = slices.select("parent", "slice", first("n", Window.partitionBy("parent").orderBy("slice")).alias("before"))
        inside = below.withColumn("inside", first("n_under", Window.partitionBy("parent", "slice").orderBy("node"))).join(slices.hint("merge"), ["parent", "slice"])
        roots = own.where("parent IS NULL").select("node", "parent", "n_under", F.lit(0).cast("long").alias("behind"))
        own = scratch.cut(inside.select("node", "parent", "n_under", (F.col("before") + F.col("inside") + 1).alias("behind")).unionByName(roots))
        # place: behind the node `at`, which moves up to the root, whose own is 0.
        placed = scratch.cut(own.select("node", F.coalesce("parent", "node").alias("at"), F.col("behind").alias("place"), F.col("parent").isNull().alias("whole")))
        while not placed.where("NOT whole").isEmpty():
            over = placed.select(F.col("node").alias("at"), F.col("at").alias("upper"), F.col("place").alias("more"), F.col("whole").alias("ends"))
            moved = placed.where("NOT whole").join(over.hint("merge"), "at").select("node", F.col("upper").alias("at"), (F.col("place") + F.col("more")).alias("place"), F.col("ends").alias("whole"))
            placed = scratch.cut(moved.unionByName(placed.where("whole")))
        above = placed.select(F.col("node").alias("parent"), F.col("place").alias("above"))
        found = own.select("node", "parent", "n_under").join(placed.select("node", F.col("at").alias("root"), "place").hint("merge"), "node")
        return cut(found.join(above.hint("merge"), "parent", "left").select("node", "root", "place", "above", "n_under"))


def place_sets(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Each set's node: the deepest one that all its members are, or lie under; with n_members, and n_under, how many nodes
    of the tree (itself included) it has under it.

    members: set, node, distinct or not. Members that are not in the tree don't count; a set without others has no row, nor has one
    whose members are in different trees.

    A set's node is that of its members with the least and the greatest place. It is the least parent of the places behind the one up to the other,
    which two stretches of a power of two cover; their least parents are a table with a row a node and power.
    """
    with Scratch(edges.sparkSession) as scratch:
        nodes = scratch.cut(number_nodes(edges))
        # Members combine before the shuffle: a set of any size is one row a task.
        met = members.where("set IS NOT NULL").select("set", "node").join(nodes.select("node", "root", "place").hint("merge"), "node").groupBy("set", "root", "place").agg(F.lit(1).alias("one"))
        ends = met.groupBy("set").agg(F.count("*").alias("n_members"), F.min("root").alias("root"), F.max("root").alias("other"), F.min("place").alias("lo"), F.max("place").alias("hi")).where("root = other").drop("other")
        # The power of two that is at most the number of places.
        ends = scratch.cut(ends.withColumn("power", F.when(F.col("lo") < F.col("hi"), F.length(F.bin(F.col("hi") - F.col("lo"))) - 1)))
        top = ends.agg(F.max("power")).first()[0]
        least = nodes.where("above IS NOT NULL").select("root", "place", "above")
        table = least.withColumn("power", F.lit(0))
        for power in range(1, (top or 0) + 1):
            right = least.select("root", (F.col("place") - (1 << (power - 1))).alias("place"), F.col("above").alias("right"))
            least = scratch.cut(least.join(right.hint("merge"), ["root", "place"]).select("root", "place", F.least("above", "right").alias("above")))
            table = table.unionByName(least.withColumn("power", F.lit(power)))
        asked = ends.where("power IS NOT NULL").select("set", "n_members", "root", "power", F.explode(F.array(F.col("lo") + 1, F.col("hi") + 1 - F.pow(F.lit(2), "power").cast("long"))).alias("place"))
        told = asked.join(table.hint("merge"), ["root", "power", "place"]).groupBy("set", "n_members", "root").agg(F.min("above").alias("place"))
        best = told.unionByName(ends.where("power IS NULL").select("set", "n_members", "root", F.col("lo").alias("place")))
        return cut(best.join(nodes.select("root", "place", "node", "n_under").hint("merge"), ["root", "place"]).select("set", "node", "n_members", "n_under"))

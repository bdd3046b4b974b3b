"""Chat formatting of reply trees.

Nodes name their parent. Jump tables (the ancestor 1, 2, 4, ... levels up, each the self-join of the one before)
give depths and path sums in as many joins as the logarithm of the deepest path; leaves are ranked by score, and
the same tables enumerate the nodes of the chosen root-to-leaf paths. Each path becomes one conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cytoflux.llm.common import cut

#: A turn is OPEN role MIDDLE text CLOSE. Texts and roles are escaped so that none of these occurs in them.
OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>\n"
LOSS_ROLE = "assistant"
#: Turns joined at once before whole paths are.
CHUNK = 256


def escape(text: Column) -> Column:
    """A backslash is doubled and one is put behind each `<` and `[`, so that no control string is left; see `unescape`."""
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescape(text: str) -> str:
    return re.sub(r"([<\[])\\|\\\\", lambda m: m[1] or "\\", text)


def chain(turns: DataFrame) -> DataFrame:
    """Conversations as trees without branches: conv_id, node, parent, role, text, score of each row, by turn.

    Rows that tie on the turn follow each other in order of role and text; repeated rows are turns of their own.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    name = lambda i: F.concat_ws("#", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), i.cast("string"))
    numbered = turns.select("conv_id", "role", "text", F.row_number().over(order).alias("i"))
    return numbered.select("conv_id", name(F.col("i")).alias("node"), F.when(F.col("i") > 1, name(F.col("i") - 1)).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def best_paths(nodes: DataFrame, per_root: int = 1) -> DataFrame:
    """leaf, node, depth (0: the root), rank of each node on the per_root best paths of each root.

    nodes: node (unique), parent, score (null: 0). A path's score is the mean of its nodes'; ties go to the leaf
    with the smaller id. A node whose parent is missing is a root; nodes on a cycle, or below one, have no root
    and are on no path. Nodes that a path shares with another one appear on each.
    """
    nodes = cut(nodes.select("node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score")).where(F.col("node").isNotNull()))
    known = nodes.select(F.col("node").alias("known"))
    parents = nodes.where(F.col("parent").isNotNull()).select(F.col("parent").alias("p")).distinct()
    linked = nodes.join(known, F.col("parent") == F.col("known"), "left").join(parents, F.col("node") == F.col("p"), "left")
    linked = linked.select("node", F.col("known").alias("up"), "score", F.col("p").isNull().alias("leaf"))
    # up: the ancestor 2 ** k levels above, null beyond the root; levels and total: how many nodes, and their scores, below it.
    active = cut(linked.select("node", "up", F.lit(1).cast("long").alias("levels"), F.col("score").alias("total"), F.col("node").alias("root"), "leaf"))
    finished, jumps, n = [], [], nodes.count()
    while True:
        # Nodes that have met their root leave, so that a round handles the nodes of paths that are still longer.
        finished.append(active.where(F.col("up").isNull()))
        active = active.where(F.col("up").isNotNull())
        if (1 << len(jumps)) > 2 * n or active.isEmpty():
            break
        jumps.append(active.select("node", "up"))
        above = reduce(DataFrame.unionByName, [*finished, active])
        above = above.select(F.col("node").alias("a_node"), F.col("up").alias("a_up"), F.col("levels").alias("a_levels"), F.col("total").alias("a_total"), F.col("root").alias("a_root"))
        active = cut(active.join(above, F.col("up") == F.col("a_node")).select("node", F.col("a_up").alias("up"), (F.col("levels") + F.col("a_levels")).alias("levels"), (F.col("total") + F.col("a_total")).alias("total"), F.col("a_root").alias("root"), "leaf"))
    leaves = reduce(DataFrame.unionByName, finished).where("leaf").select("node", "root", "levels", (F.col("total") / F.col("levels")).alias("mean"))
    rank = F.row_number().over(Window.partitionBy("root").orderBy(F.desc("mean"), "node"))
    chosen = leaves.withColumn("rank", rank).where(F.col("rank") <= per_root)
    paths = cut(chosen.select(F.col("node").alias("leaf"), "node", (F.col("levels") - 1).alias("depth"), "rank"))
    # Each distance from the leaf is a sum of distinct powers of two, so each ancestor comes up once.
    for k, j in enumerate(jumps):
        up = paths.join(j.select(F.col("node").alias("j_node"), "up"), F.col("node") == F.col("j_node")).select("leaf", F.col("up").alias("node"), (F.col("depth") - (1 << k)).alias("depth"), "rank")
        paths = cut(paths.unionByName(up))
    return paths


def format_paths(nodes: DataFrame, per_root: int = 1) -> DataFrame:
    """conv_id, leaf, rank, formatted and loss (code-point spans of the assistants' texts, end exclusive) of each chosen path.

    nodes: conv_id, node, parent, role, text, score. Null roles and texts are empty. An empty table gives no rows.
    """
    turns = best_paths(nodes, per_root).join(nodes.select("conv_id", "node", "role", "text"), "node")
    text, head = escape(F.col("text")), F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE))
    turns = turns.select("conv_id", "leaf", "rank", "depth", F.concat(head, text, F.lit(CLOSE)).alias("turn"), F.length(head).cast("long").alias("before"), F.length(text).cast("long").alias("n"), (F.col("role") == LOSS_ROLE).alias("counts"))
    # Long paths are joined piece by piece, so that a path's rows don't all meet in one task.
    piece = F.sort_array(F.collect_list(F.struct("depth", "turn", "before", "n", "counts")))
    pieces = turns.groupBy("conv_id", "leaf", "rank", F.floor(F.col("depth") / CHUNK).alias("chunk")).agg(piece.alias("turns"))
    pieces = pieces.select("conv_id", "leaf", "rank", "chunk", F.array_join(F.transform("turns", lambda x: x["turn"]), "").alias("part"), F.transform("turns", lambda x: F.struct(F.length(x["turn"]).cast("long").alias("size"), x["before"].alias("before"), x["n"].alias("n"), x["counts"].alias("counts"))).alias("marks"))
    whole = pieces.groupBy("conv_id", "leaf", "rank").agg(F.sort_array(F.collect_list(F.struct("chunk", "part", "marks"))).alias("parts"))
    marks = F.flatten(F.transform("parts", lambda x: x["marks"]))
    whole = whole.select("conv_id", "leaf", "rank", F.array_join(F.transform("parts", lambda x: x["part"]), "").alias("formatted"), marks.alias("marks"))

    @F.pandas_udf("array<struct<start:bigint,end:bigint>>")
    def loss(paths: pd.Series) -> pd.Series:
        return paths.map(loss_spans)

    return whole.select("conv_id", "leaf", "rank", "formatted", loss("marks").alias("loss"))


def loss_spans(turns) -> list[dict[str, int]]:
    """Where the counted texts of a path lie, from the sizes of its turns."""
    at, spans = 0, []
    for t in turns:
        if t["counts"]:
            spans.append({"start": at + t["before"], "end": at + t["before"] + t["n"]})
        at += t["size"]
    return spans


READ_BACK = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def parse(formatted: str, loss) -> tuple[list[tuple[str, str]], list[str]]:
    """(role, text) of each turn, and the texts under the loss mask, unescaped: what `format_paths` put in."""
    turns = [t.removeprefix(OPEN).split(MIDDLE, 1) for t in formatted.split(CLOSE)[:-1]]
    return [(unescape(role), unescape(text)) for role, text in turns], [unescape(formatted[s["start"] : s["end"]]) for s in loss]


def digest(formatted: DataFrame) -> DataFrame:
    """conv_id and, read back from the output, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars."""
    hexed = lambda text: hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    @F.pandas_udf(READ_BACK)
    def read_back(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, losses in batches:
            rows = []
            for text, loss in zip(texts, losses, strict=True):
                turns, masked = parse(text, loss)
                rows.append((len(turns), hexed("".join(f"{role}\n{said}\n" for role, said in turns)), sum(map(len, masked)), hexed("".join(masked)), len(text)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in READ_BACK.split(", ")])

    return formatted.withColumn("r", read_back("formatted", "loss")).select("conv_id", "r.*")

"""Near-duplicate documents with SetSketch registers.

A document's set of word shingles is sketched into exponentially spaced, truncated minima: register i holds
floor(1 - log_b(x)) of the least of exponentially distributed hashes x of the shingles. The register of a union is
the larger of the two (`merge`). Bands of registers bring candidates together, the joint likelihood of two sketches
estimates their similarity, and what the estimate does not rule out is verified on the full sets.

No bucket is expanded into all its pairs. Each member meets the bucket's least and greatest member; verified links
give components; where a bucket still holds several components, only members outside its main one are compared
with the others, block by block, inside a task. Documents with equal sets are one node throughout.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoflux.llm.anchors import mix
from cytoflux.llm.common import Scratch, cut, fresh
from cytoflux.llm.components import components

SHINGLE, PERCENT = 5, 80
REGISTERS, BASE, TOP = 252, 1.02, 1200
#: Either of these is less likely than this for a pair that reaches the threshold: it shares no band; its estimate
#: rules it out.
MISS = 1e-8
BLOCK = 512
_RNG = np.random.default_rng(20240229)
_A = _RNG.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 1 << 32, REGISTERS, dtype=np.uint64).astype(np.uint32)
#: Multipliers of the places in a run, one column for each half of a word's digest.
_C = np.array([int(x) | 1 for x in _RNG.integers(0, 1 << 63, 128)], np.uint64).reshape(64, 2)
#: Words that a worker remembers the digests of, and how long they may be.
REMEMBERED, SHORT = 1 << 19, 64
#: Nodes whose texts are sought by a broadcast of 64 bits each.
BROADCAST_NODES = 500_000


class _Digests(dict):
    """128 bits of a keyed BLAKE2 of each word's bytes; collisions can't be built from a word's structure."""

    def __missing__(self, word: bytes) -> bytes:
        digest = hashlib.blake2b(word, digest_size=16, key=b"near-duplicates").digest()
        if len(word) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = digest
        return digest


_DIGESTS = _Digests()


def words(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lowered, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes are lowered and split by ASCII alone


def _runs(text: str | None, k: int) -> np.ndarray:
    """Two 64-bit hashes of each run of k words; fewer words are one run; none: no row."""
    of_text = words(text)
    digests = np.frombuffer(b"".join(map(_DIGESTS.__getitem__, of_text)), np.uint64).reshape(-1, 2)
    k = min(k, len(digests))
    out = np.full((len(digests) - k + 1 if k else 0, 2), k, np.uint64)
    for j in range(k):
        out = mix(out + digests[j : len(digests) - k + 1 + j] * _C[j])
    return out


def shingles(text: str | None, k: int) -> np.ndarray:
    """Distinct 64-bit hashes of the runs of k words (A-Z lowered); fewer words are one run; none: empty."""
    return np.unique(_runs(text, k)[:, 0])


def word_runs(text: str | None, k: int) -> set[tuple[bytes, ...]]:
    """The set of shingles itself, for the confirmation of links."""
    of_text = words(text)
    return set(zip(*(of_text[j:] for j in range(min(k, len(of_text))))))


def confirmed(a: set, b: set, percent: int) -> bool:
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The registers of a set; all 0 for none."""
    if not len(hashes):
        return np.zeros(REGISTERS, np.int16)
    h = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(h), 1024):
        np.minimum(least, (h[at : at + 1024, None] * _A + _B).min(0), out=least)
    x = -np.log1p(-(least.astype(np.float64) + 0.5) / 4294967296.0)
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP).astype(np.int16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def estimate(larger: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The similarity of greatest joint likelihood: larger and smaller say how many registers of a exceed, or fall
    short of, those of b; n_a and n_b are the sizes of the sets."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    p = lambda x: np.clip(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-12, 1.0)

    def likelihood(j):
        more, less = p(u - v * j), p(v - u * j)
        return larger * np.log(more) + smaller * np.log(less) + (REGISTERS - larger - smaller) * np.log(np.clip(1 - more - less, 1e-12, 1.0))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(24):  # the likelihood has one peak
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        left = likelihood(a) > likelihood(b)
        lo, hi = np.where(left, lo, a), np.where(left, b, hi)
    return (lo + hi) / 2


def bands(percent: int) -> tuple[int, int]:
    """Registers in a band, and bands: the longest bands with which a pair at the threshold is missed less often than MISS."""
    rows = max(r for r in range(1, 13) if (1 - (percent / 100) ** r) ** (REGISTERS // r) < MISS or r == 1)
    return rows, REGISTERS // rows


def least_estimate(percent: int) -> float:
    """Pairs with a lower estimate are ruled out. At the threshold t as many of the registers agree as in that many
    draws with probability t; the bound is the count that fewer agree with less often than MISS."""
    t, tail, count = percent / 100, 0.0, 0
    while (tail := tail + math.comb(REGISTERS, count) * t**count * (1 - t) ** (REGISTERS - count)) < MISS:
        count += 1
    return count / REGISTERS


def text_key() -> Column:
    """The 16 bytes of the text's MD5; null is as empty."""
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


SKETCHED = "doc_id {}, key binary, n long, node binary, sketch binary"


def sketch_documents(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, key (see `text_key`), n (shingles), node (digest of the set; null for none) and sketch of each document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch["key"], batch["text"], strict=True):
                runs = _runs(text, k)
                s, first = np.unique(runs[:, 0], return_index=True)
                both = s.tobytes() + runs[first, 1].tobytes()
                rows.append((key, len(s), hashlib.blake2b(both, digest_size=16).digest() if len(s) else None, sketch(s).tobytes() if len(s) else None))
            out = pd.DataFrame(rows, columns=["key", "n", "node", "sketch"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy() if len(batch) else [])
            yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_key().alias("key"), "text").mapInPandas(run, SKETCHED.format(kind))


def _registers(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.int16).reshape(-1, REGISTERS)


def _likely(percent: int):
    @F.pandas_udf("boolean")
    def likely(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for a, b, n_a, n_b in batches:
            if not len(a):
                yield pd.Series([], dtype=bool)
                continue
            x, y = _registers(a), _registers(b)
            yield pd.Series(estimate((x > y).sum(1), (x < y).sum(1), n_a.to_numpy(float), n_b.to_numpy(float)) >= least_estimate(percent))

    return likely


def _verify(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b: nodes) whose full sets reach the threshold. texts: node, text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, of_last, exact = None, None, None
        for batch in batches:
            good = []
            for a, x, y in zip(batch["a"], batch["text_a"], batch["text_b"], strict=True):
                if a != last:
                    last, of_last, exact = a, shingles(x, k), None
                other = shingles(y, k)
                both = len(np.intersect1d(of_last, other, assume_unique=True))
                linked = 100 * both >= percent * (len(of_last) + len(other) - both)
                if linked:  # hashes propose, words decide
                    exact = word_runs(x, k) if exact is None else exact
                    linked = confirmed(exact, word_runs(y, k), percent)
                good.append(linked)
            yield batch.loc[np.array(good, bool), ["a", "b"]]

    # The texts of b arrive by a shuffle of b, those of a by one of a: tasks then hold a's rows together.
    half = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    full = half.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return full.select("a", "b", "text_a", "text_b").mapInPandas(run, "a binary, b binary")


def _shared(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a set with several others, all sorted."""
    if not others:
        return np.zeros(0, int)
    flat = np.concatenate(others)
    found = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
    ends = np.cumsum([len(o) for o in others])
    sums = np.concatenate([[0], np.cumsum(found)])
    return sums[ends] - sums[ends - np.array([len(o) for o in others])]


def _rest_of_block(k: int, percent: int, rows: int):
    """Links between left and right members of a block that belong to different components, share a band, are not
    ruled out by the estimate and reach the threshold on their full sets: roots of the components that these connect,
    as few pairs as connect them."""
    low, used = least_estimate(percent), REGISTERS // rows * rows

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found: set[tuple[bytes, bytes]] = set()
        if len(left) and len(right):
            x, y = _registers(left["sketch"]), _registers(right["sketch"])
            n, nodes = right["n"].to_numpy(float), right["node"].to_numpy()
            names, labels = np.unique(np.concatenate([right["root"].to_numpy(), left["root"].to_numpy()]), return_inverse=True)
            of_right, of_left = labels[: len(right)].copy(), labels[len(right) :].copy()
            inside = (right["root"] == right["main_root"]).to_numpy()
            sets: dict[int, np.ndarray] = {}
            exact: dict[int, set] = {}
            for i in range(len(left)):
                node, own = left["node"].iloc[i], float(left["n"].iloc[i])
                # Two members outside the main component meet twice; one of the meetings counts.
                ok = (of_right != of_left[i]) & (inside | (nodes > node)) & (100 * np.minimum(n, own) >= percent * np.maximum(n, own))
                at = np.flatnonzero(ok)
                at = at[(x[i, :used] == y[at][:, :used]).reshape(len(at), used // rows, rows).all(2).any(1)]
                if not len(at):
                    continue
                likely = estimate((x[i] > y[at]).sum(1), (x[i] < y[at]).sum(1), np.full(len(at), own), n[at])
                at = at[np.argsort(-likely, kind="stable")][: (likely >= low).sum()]
                mine = shingles(left["text"].iloc[i], k) if len(at) else None
                mine_exact = None
                while len(at):
                    # The likeliest of each component; once linked, the component's others need no comparison.
                    first = np.unique(of_right[at], return_index=True)[1]
                    for j in at[first]:
                        if j not in sets:
                            sets[j] = shingles(right["text"].iloc[j], k)
                    both = _shared(mine, [sets[j] for j in at[first]])
                    for j in at[first][100 * both >= percent * (own + n[at[first]] - both)]:
                        if (now := of_right[j]) != of_left[i]:
                            mine_exact = word_runs(left["text"].iloc[i], k) if mine_exact is None else mine_exact
                            if j not in exact:
                                exact[j] = word_runs(right["text"].iloc[j], k)
                            if not confirmed(mine_exact, exact[j], percent):
                                continue
                            found.add(tuple(sorted((names[now], names[of_left[i]]))))
                            of_right[of_right == now] = of_left[of_left == now] = of_left[i]
                    at = np.delete(at, first)
                    at = at[of_right[at] != of_left[i]]
        return pd.DataFrame(sorted(found), columns=["a", "b"])

    return run


def _star_links(nodes: DataFrame, met: DataFrame, docs: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """Verified links (a, b) of the members of buckets with the bucket's least and greatest member."""

    def pairs_of(other: str) -> DataFrame:
        return met.where(F.col("node") != F.col(other)).select(F.least("node", other).alias("a"), F.greatest("node", other).alias("b"))

    def attach(pairs: DataFrame, side: str) -> DataFrame:
        return pairs.join(nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")), side)

    stars = pairs_of("low").unionByName(pairs_of("high")).distinct()
    sized = attach(attach(stars, "a"), "b").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    stars = scratch.cut(sized.where(_likely(percent)("sketch_a", "sketch_b", "n_a", "n_b")).select("a", "b"))
    ends = stars.select(F.col("a").alias("node")).union(stars.select("b"))
    # Written, so that the join has an exchange of its own on either side and a frequent end's pairs can be split.
    return scratch.cut(_verify(stars, scratch.cut(_texts(ends, nodes, docs, scratch)), k, percent))


def _texts(some: DataFrame, nodes: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """node, text: one text for each node of some."""
    wanted = scratch.cut(nodes.select("node", "key").join(some.select("node").distinct(), "node", "left_semi"))
    keyed = docs.select(text_key().alias("key"), "text")
    if wanted.count() <= BROADCAST_NODES:
        # Other texts stay where they are: the scan drops them before the shuffle.
        short = wanted.select(F.xxhash64("key").alias("short")).distinct()
        keyed = keyed.join(F.broadcast(short), F.xxhash64("key") == F.col("short"), "left_semi")
    # One row a text before the shuffle, however many have it.
    return keyed.groupBy("key").agg(F.first("text").alias("text")).join(wanted, "key").select("node", "text")


def _merged_roots(nodes: DataFrame, met: DataFrame, roots: DataFrame, docs: DataFrame, k: int, percent: int, block: int, scratch: Scratch) -> DataFrame | None:
    """root, merged: the components' roots that links inside still open buckets lead on to another root; None without one.

    A bucket is open if the links known so far leave it in several components. Of each: its members, once for each
    component that is the largest of one of their buckets; all but that one's meet the others, block by block.
    """
    labelled = scratch.cut(met.where("size > 2").join(roots, "node", "left").select("h", "node", F.coalesce("root", "node").alias("root")))
    inside = labelled.groupBy("h", "root").agg(F.count("*").alias("n"))
    open_ = inside.groupBy("h").agg(F.count("*").alias("n_roots"), F.max(F.struct("n", "root")).alias("main")).where("n_roots > 1").select("h", F.col("main.root").alias("main_root"))
    rest = scratch.cut(labelled.join(open_, "h").select("main_root", "node", "root").distinct())
    if rest.isEmpty():
        return None
    outside = F.count_if(F.col("root") != F.col("main_root"))
    sizes = scratch.cut(rest.groupBy("main_root").agg(F.ceil(F.count("*") / block).cast("int").alias("rights"), F.ceil(outside / block).cast("int").alias("lefts")))
    texts = nodes.select("node", "n", "sketch").join(_texts(rest, nodes, docs, scratch), "node")
    rest = scratch.cut(rest.join(sizes, "main_root")).join(texts, "node")
    dealt = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")
    columns = ["main_root", "node", "root", "n", "sketch", "text"]
    left = rest.where("root <> main_root").select(*columns, dealt("lefts", 1).alias("l"), F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("r"))
    # New names for Spark, which else takes the two sides' columns for the same ones.
    right = rest.select(*[F.col(c).alias(c) for c in columns], F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("l"), dealt("rights", 2).alias("r"))
    more = left.groupBy("main_root", "l", "r").cogroup(right.groupBy("main_root", "l", "r")).applyInPandas(_rest_of_block(k, percent, bands(percent)[0]), "a binary, b binary")
    more = scratch.cut(more.distinct())
    return None if more.isEmpty() else components(more, scratch).select(F.col("node").alias("root"), F.col("root").alias("merged"))


def _rooted(docs: DataFrame, k: int, percent: int, block: int) -> DataFrame:
    """doc_id, key (see `text_key`), n and root (the component; null without a word) of each row."""
    rows, n_bands = bands(percent)
    with Scratch(docs.sparkSession) as scratch:
        sketched = scratch.cut(sketch_documents(docs.select("doc_id", "text"), k))
        nodes = scratch.cut(sketched.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("key").alias("key")))

        width = 2 * rows
        hashes = F.array(*[F.xxhash64(F.lit(i), F.substring("sketch", 1 + i * width, width)) for i in range(n_bands)])
        members = nodes.select("node", F.explode(hashes).alias("h"))
        buckets = scratch.cut(members.groupBy("h").agg(F.count("*").alias("size"), F.min("node").alias("low"), F.max("node").alias("high")).where("size > 1"))
        met = scratch.cut(members.join(buckets, "h"))
        roots = components(_star_links(nodes, met, docs, k, percent, scratch), scratch)
        out = sketched.select("doc_id", "key", "n", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).drop("node")
        if (merged := _merged_roots(nodes, met, roots, docs, k, percent, block, scratch)) is not None:
            out = out.join(merged, "root", "left").withColumn("root", F.coalesce("merged", "root")).drop("merged")
        return cut(out)


def classes(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the least doc_id that links reach) and kept.

    Links join documents whose sets of k-word shingles have 100 * intersection >= percent * union; a text with
    fewer words is one shingle; null texts and texts without a word are linked with nothing. Null ids: a component's
    id is the least that is not null, and null if there is none; a row is kept if its id is its component's. Repeated
    rows have equal sets and are linked. An empty table gives no rows.
    """
    named = _rooted(docs, k, percent, block)
    # Written, so that the join has an exchange of its own on either side and a large component's rows can be split.
    ids = cut(named.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id")))
    out = named.join(ids, "root", "left").withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """The rows of docs that stay: one of each component, and every row whose text has no word.

    The row with the least id that is not null stays, then the one with the least MD5 of its text; of rows with the
    same id and text the one whose columns are least. Decided by row: other rows with its id don't come back.
    """
    rooted = _rooted(docs.select("doc_id", "text"), k, percent, block)
    # n_rows: how many rows have the chosen id and text. Counted before the choice, so that repeated rows are few.
    pairs = rooted.where("n > 0").groupBy("root", "doc_id", "key").agg(F.count("*").alias("n_rows"))
    best = pairs.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "n_rows")).alias("best"))
    worded = best.select(F.col("best.doc_id").alias("doc_id"), F.col("best.key").alias("key"), F.col("best.n_rows").alias("n_rows"))
    wordless = rooted.where("n = 0").select("doc_id", "key").distinct().withColumn("n_rows", F.lit(1).cast("long"))
    kept_id, kept_key, n_rows, row = fresh(docs, "kept_id", "kept_key", "n_rows", "row")
    chosen = cut(worded.unionByName(wordless).toDF(kept_id, kept_key, n_rows))
    same = F.col("doc_id").eqNullSafe(F.col(kept_id)) & (text_key() == F.col(kept_key))
    single = docs.join(chosen.where(F.col(n_rows) == 1), same, "left_semi")
    repeated = chosen.where(F.col(n_rows) > 1)
    if repeated.isEmpty():
        return single
    least = docs.join(repeated, same).groupBy(kept_id, kept_key).agg(F.min(F.struct(*docs.columns)).alias(row))
    return single.unionByName(least.select(f"{row}.*"))

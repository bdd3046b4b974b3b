"""Long repeated passages: longest previous and next factors over truncated suffixes.

A string of LENGTH bytes starts elsewhere too if the longest previous factor of its place reaches LENGTH, or the
longest next one. Such factors follow from the suffixes' first LENGTH bytes alone, and the suffix order over the
whole corpus falls into blocks: each suffix goes to the content-defined anchor of its first LENGTH bytes (the least
hash of their GRAM-byte strings), and equal ones share their anchor. A block holds the suffixes of one anchor, as the
stretches of text that they span.

1. Every stretch becomes one row: hash of the anchor, hashes of the stretch, place. Anchors seen once drop out in an
   aggregation that combines before the shuffle.
2. Stretches that agree as a whole (in the 128 bits of a BLAKE2 digest) are represented by the first; the others' suffixes
   all have a previous factor. Where an anchor has one kind of stretch, that is all.
3. The representatives of an anchor are compared inside their block: suffixes in order of their bytes, ties by place, with
   the bytes that neighbours share; from these, previous and next smaller places give the lengths of the longest previous
   factors, greater places those of the next ones (`factors`). Factors of LENGTH bytes go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoflux.llm.anchors import Hashes, anchors
from cytoflux.llm.common import Scratch, cut

LENGTH, GRAM = 200, 32
#: Representatives that a block may have to be compared in one task; those of larger blocks are shuffled suffix by suffix.
BLOCK = 20_000
#: Bytes of stretches that are ordered at once.
CHUNK = 2 << 20
WORD = 8
KIND = ["anchor", "stretch", "check"]


def _stretches(docs: DataFrame, length: int, bits: int, whole: bool) -> DataFrame:
    """anchor and stretch (hashes); whole: also check (a second hash), key (of the document) and place, which is the
    first byte * 2 ** 32 + the end byte. docs: key, text. bits: of the hashes, fewer than 64 in tests."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = np.uint64((1 << bits) - 1)
        for batch in batches:
            parts, keys = [], []
            for key, text in zip(batch["key"], batch["text"], strict=True):
                data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
                if len(data) < length:
                    continue
                of = Hashes(data)
                grams = of.runs(GRAM)
                at, first, last = anchors(grams, length - GRAM + 1)
                end = last + length
                if whole:
                    digests = _digests(data, first, end)
                    parts.append((grams[at] & kept, digests[:, 0] & kept, digests[:, 1], (first << 32) | end))
                else:
                    parts.append((grams[at] & kept, of.of(first, end) & kept))
                keys += [key] * len(at) if whole else []
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * (4 if whole else 2)
            out = pd.DataFrame({n: c.view(np.int64) for n, c in zip([*KIND, "place"] if whole else KIND[:2], columns, strict=True)})
            yield out.assign(key=pd.Series(keys, dtype=object)) if whole else out

    schema = "anchor long, stretch long" + ", check long, place long, key binary" * whole
    return docs.select("key", "text").mapInPandas(run, schema)


def _digests(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Two 64-bit halves of the BLAKE2 digest of each data[first:end]: strings that agree in both are taken for equal."""
    view = memoryview(np.ascontiguousarray(data))
    raw = b"".join([hashlib.blake2b(view[a:e], digest_size=16, key=b"long-repeats").digest() for a, e in zip(first.tolist(), end.tolist(), strict=True)])
    return np.frombuffer(raw, np.uint64).reshape(-1, 2)


def _suffixes(lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of stretches laid end to end: which one each suffix of `length` bytes or more belongs to, and where it starts."""
    n = np.maximum(lengths - length + 1, 0)
    begin = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(lengths)), n)
    return owner, begin[owner] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _big_endian(data: np.ndarray) -> np.ndarray:
    """The WORD bytes from each place on as a number that sorts as they do."""
    n, words = len(data) - WORD + 1, np.zeros(max(len(data) - WORD + 1, 0), np.uint64)
    for j in range(WORD if n > 0 else 0):
        words = (words << np.uint64(8)) | data[j : n + j]
    return words


def _names(words: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the strings of `length` bytes that start at `at`, by their bytes; equal strings share a rank."""
    rank, open_ = np.zeros(len(at), np.int64), np.arange(len(at))
    for k in range(0, length if len(at) else 0, WORD):
        own = words[at[open_] + min(k, length - WORD)]
        order = np.lexsort((own, rank[open_]))
        open_, own = open_[order], own[order]
        new = np.r_[True, (rank[open_[1:]] != rank[open_[:-1]]) | (own[1:] != own[:-1])]
        # A rank is the number of strings in front, so that a group splits without moving other groups.
        group = np.r_[True, rank[open_[1:]] != rank[open_[:-1]]]
        place = np.arange(len(open_))
        in_front = np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
        rank[open_] += in_front
        alone = new & np.r_[new[1:], True]
        open_ = open_[~alone]
        if not len(open_):
            break
    return rank


def suffix_order(data: np.ndarray, at: np.ndarray, length: int, bits: int = 64, every: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Of the suffixes at the places `at`, ascending, those whose first `length` bytes may occur twice: their numbers in
    order of these bytes, ties by place, and the rank of the bytes, equal for equal ones.

    Suffixes whose hash no other one has are left out: they have no factor of that length. Of those with equal
    hashes one is ordered, and the others are compared with it byte by byte; any that differ are ordered themselves.
    every: suffixes of any hash have a place in the order.
    """
    hashes = Hashes(data).runs(length)[at] & np.uint64((1 << bits) - 1)
    order = np.argsort(hashes, kind="stable")
    new = np.r_[True, hashes[order][1:] != hashes[order][:-1]] if len(order) else np.zeros(0, bool)
    several = ~(new & np.r_[new[1:], True]) | every if len(order) else new
    order, new = order[several], new[several]
    words, one = _big_endian(data), np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    same = np.ones(len(order), bool)
    for k in range(0, length if len(order) else 0, WORD):
        x = words[at[order] + min(k, length - WORD)]
        same &= x == x[one]
    ordered = np.flatnonzero(new | ~same)
    rank = np.zeros(len(order), np.int64)
    rank[ordered] = _names(words, at[order[ordered]], length)
    rank[same] = rank[one[same]]
    by = np.lexsort((order, rank))
    return order[by], rank[by]


def common_prefixes(data: np.ndarray, at: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """How many bytes, `length` at most, the suffix at each place has in common with the one in front of it in the order; 0 for the first."""
    out = np.where(np.r_[False, rank[1:] == rank[:-1]][: len(rank)], length, 0)
    words, open_ = _big_endian(data), np.flatnonzero(np.r_[False, rank[1:] != rank[:-1]][: len(rank)])
    for k in range(0, length if len(open_) else 0, WORD):
        begin = min(k, length - WORD)
        differ = words[at[open_] + begin] ^ words[at[open_ - 1] + begin]
        here, x = open_[differ != 0], differ[differ != 0]
        equal = np.zeros(len(here), np.int64)
        for j in range(1, WORD):
            equal += (x >> np.uint64(8 * (WORD - j))) == 0
        out[here] = begin + equal
        open_ = open_[differ == 0]
    return out


def _nearest(place: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The bytes that each suffix shares with the nearest one in front of it, in the order, whose place is smaller; 0 without one.

    Pointers go to the suffix in front and, while its place is greater, on to where that one's pointer goes: all between have
    greater places. The least common prefix on the way is what both share.
    """
    n = len(place)
    to, shared = np.arange(-1, n - 1), common.copy()
    open_ = np.flatnonzero(to >= 0)
    open_ = open_[place[to[open_]] > place[open_]]
    while len(open_):
        over = to[open_]
        shared_new, to_new = np.minimum(shared[open_], shared[over]), to[over]
        shared[open_], to[open_] = shared_new, to_new
        open_ = open_[to_new >= 0]
        open_ = open_[place[to[open_]] > place[open_]]
    return np.where(to >= 0, shared, 0)


def factors(place: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of suffixes in order: the length of each one's longest previous factor, and of its longest next one, as far as `common` counts.

    The longest previous factor is shared with the previous or the next smaller place in the order, the longest next
    factor with the previous or the next greater one.
    """
    behind = np.r_[common[1:], 0][: len(common)][::-1]
    longest = lambda p: np.maximum(_nearest(p, common), _nearest(p[::-1], behind)[::-1])
    return longest(place), longest(-place)


def _runs(owner: np.ndarray, at: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """owner, first, end of each run of bytes under the suffixes that start at `at`."""
    if len(at):
        breaks = np.flatnonzero((np.diff(owner) != 0) | (np.diff(at) > length)) + 1
        for a, e in zip(np.r_[0, breaks], np.r_[breaks, len(at)] - 1, strict=True):
            yield int(owner[a]), int(at[a]), int(at[e]) + length


def _compare(length: int, bits: int, keep_first: bool):
    """Blocks, whole, one after the other and each in order of key and place -> key, place of what goes: the bytes of
    suffixes with a previous factor, or, unless the first is kept, a next one."""

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows["bytes"].map(len).to_numpy()
        owner, at = _suffixes(sizes, length)
        data = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
        order, rank = suffix_order(data, at, length, bits)
        previous, following = factors(order, common_prefixes(data, at[order], rank, length))
        goes = np.zeros(len(at), bool)
        goes[order] = (previous >= length) | ((following >= length) & (not keep_first))
        begin, first = np.cumsum(sizes) - sizes, (rows["place"].to_numpy() >> 32)
        keys, out = rows["key"].to_numpy(), []
        for o, a, e in _runs(owner[goes], at[goes], length):
            out.append((keys[o], (int(first[o] + a - begin[o]) << 32) | int(first[o] + e - begin[o])))
        return pd.DataFrame(out, columns=["key", "place"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            size += int(batch["bytes"].map(len).sum())
            if size > CHUNK:
                rows = pd.concat(held, ignore_index=True)
                # The last block may go on in the next batch.
                open_ = (rows["anchor"] == rows["anchor"].iloc[-1]).to_numpy()
                if not open_.all():
                    yield settle(rows[~open_].reset_index(drop=True))
                    rows = rows[open_].reset_index(drop=True)
                held, size = [rows], int(rows["bytes"].map(len).sum())
        if held:
            yield settle(pd.concat(held, ignore_index=True))

    return run


def _each_suffix(length: int):
    """For blocks that are too large for a task: digest, key and start of every suffix."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            sizes = batch["bytes"].map(len).to_numpy()
            owner, at = _suffixes(sizes, length)
            data = np.frombuffer(b"".join(batch["bytes"]), np.uint8)
            h, check = _digests(data, at, at + length).view(np.int64).T
            begin, first = np.cumsum(sizes) - sizes, (batch["place"].to_numpy() >> 32)
            yield pd.DataFrame({"h": h, "check": check, "key": batch["key"].to_numpy()[owner], "start": first[owner] + at - begin[owner]})

    return run


def _picked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of each stretch of a text."""
    for batch in batches:
        out = []
        for key, text, of in zip(batch["key"], batch["text"], batch["of"], strict=True):
            data = text.encode("utf-8", "surrogatepass")
            out += [(x["anchor"], key, x["place"], x["large"], data[x["place"] >> 32 : x["place"] & 0xFFFFFFFF]) for x in of]
        yield pd.DataFrame(out, columns=["anchor", "key", "place", "large", "bytes"])


def repeated_runs(docs: DataFrame, length: int = LENGTH, block: int = BLOCK, keep_first: bool = False, bits: int = 64) -> DataFrame:
    """key and places (array of first byte * 2 ** 32 + end byte) of runs, which may overlap, that hold every repeated byte.

    docs: key (16 bytes, of the text: rows with equal texts share it) and text. keep_first: without the bytes of
    strings that start nowhere before, in order of key and place; texts count once then, however many rows have them.
    """
    with Scratch(docs.sparkSession) as scratch:
        if keep_first:
            docs = docs.groupBy("key").agg(F.first("text").alias("text"))
        counted = _stretches(docs, length, bits, False).groupBy("anchor").agg(F.count("*").alias("n"), F.min("stretch").alias("low"), F.max("stretch").alias("high"))
        # Written, so that the join below has an exchange of its own on either side and a frequent anchor's rows can be split.
        repeated = scratch.cut(counted.where("n > 1").select("anchor", (F.col("low") == F.col("high")).alias("equal")))
        hits = scratch.cut(_stretches(docs, length, bits, True).join(repeated, "anchor"))
        # Anchors whose stretches agree in one hash alone.
        apart = scratch.cut(hits.where("equal").groupBy("anchor").agg(F.min("check").alias("low"), F.max("check").alias("high")).where("low <> high").select("anchor", F.lit(True).alias("apart")))
        if not apart.isEmpty():
            hits = hits.join(apart, "anchor", "left").withColumn("equal", F.col("equal") & F.col("apart").isNull()).drop("apart")
        mixed = hits if keep_first else hits.where("NOT equal")
        kinds = scratch.cut(mixed.groupBy(*KIND).agg(F.count("*").alias("n"), F.min(F.struct("key", "place")).alias("one")))
        copies = mixed.join(kinds.where("n > 1").select(*KIND, "one"), KIND)
        gone = [copies.where(F.struct("key", "place") != F.col("one")).select("key", "place")] if keep_first else [copies.select("key", "place"), hits.where("equal").select("key", "place")]

        # The representatives of anchors with several kinds, unless all of them are gone already.
        sizes = kinds.groupBy("anchor").agg(F.count("*").alias("n_kinds"), F.count_if(F.col("n") == 1).alias("singles")).where("n_kinds > 1" if keep_first else "n_kinds > 1 AND singles > 0")
        any_large = not sizes.where(F.col("n_kinds") > block).isEmpty()
        wanted = kinds.join(sizes.select("anchor", (F.col("n_kinds") > block).alias("large")), "anchor").select(F.col("one.key").alias("key"), "anchor", F.col("one.place").alias("place"), "large")
        by_text = wanted.groupBy("key").agg(F.collect_list(F.struct("anchor", "place", "large")).alias("of"))  # as many as a text has anchors
        # One row a text before the shuffle, however many have it.
        texts = docs.groupBy("key").agg(F.first("text").alias("text")).join(by_text, "key")
        stretches = texts.mapInPandas(_picked, "anchor long, key binary, place long, large boolean, bytes binary")
        stretches = scratch.cut(stretches) if any_large else stretches  # blocks of either kind read them then
        small = stretches.where("NOT large").select("anchor", "key", "place", "bytes")
        # Tasks take whole blocks, in order, and hold one block and a batch at a time.
        gone.append(small.repartition("anchor").sortWithinPartitions("anchor", "key", "place").mapInPandas(_compare(length, bits, keep_first), "key binary, place long"))
        if any_large:
            suffixes = stretches.where("large").mapInPandas(_each_suffix(length), "h long, check long, key binary, start long")
            seen = suffixes.groupBy("h", "check").agg(F.count("*").alias("times"), F.min(F.struct("key", "start")).alias("one")).where("times > 1")
            met = suffixes.join(seen, ["h", "check"])
            met = met.where(F.struct("key", "start") != F.col("one")) if keep_first else met
            gone.append(met.select("key", (F.shiftleft("start", 32) + F.col("start") + length).alias("place")))
        runs = gone[0]
        for more in gone[1:]:
            runs = runs.unionByName(more)
        return cut(runs.groupBy("key").agg(F.collect_set("place").alias("places")))  # as many as a text has anchors, or bytes


REMOVED = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", length: int = LENGTH, block: int = BLOCK, texts: bool = False, keep_first: bool = False, bits: int = 64) -> DataFrame:
    """One row per document: its id, n_bytes, n_removed, n_spans, kept_sha256 (and, if asked for, kept: the bytes left).

    Removes each byte of the whole text, as UTF-8, covered by a string of `length` bytes that also starts anywhere
    else, in this document or another; strings don't cross documents, and all copies go. keep_first: a string's first
    copy stays, in order of the texts' MD5, then of the place; of rows with equal texts the one with the least id, or
    all that have it. Null and empty texts have 0 bytes; texts shorter than `length` stay whole; repeated rows lose
    everything if they are long enough; very long texts are judged whole. Bytes left may cut a character in two, so
    that `kept` is binary. Other columns of docs play no part. An empty table gives no rows.
    """
    md5 = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    keyed = docs.select(F.col(id_col).alias("id"), "text", md5.alias("key"))
    runs = repeated_runs(keyed.select("key", "text"), length, block, keep_first, bits)
    joined = keyed.join(runs, "key", "left").withColumn("later", F.lit(False))
    if keep_first:
        first = cut(keyed.groupBy("key").agg(F.min("id").alias("first")))
        joined = joined.join(first, "key").withColumn("later", ~F.col("id").eqNullSafe(F.col("first")))

    def strip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, places, later in zip(batch["text"], batch["places"], batch["later"], strict=True):
                data, left, upto, spans = (text or "").encode("utf-8", "surrogatepass"), [], 0, 0
                runs = [len(data)] if later and len(data) >= length else sorted(map(int, places)) if places is not None else ()
                for place in runs:
                    first, end = place >> 32, place & 0xFFFFFFFF
                    if first > upto or not spans:
                        left.append(data[upto:first])
                        spans += 1
                    upto = max(upto, end)
                left.append(data[upto:])
                kept = b"".join(left)
                out.append((len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest(), *[kept] * texts))
            rows = pd.DataFrame(out, columns=[c.split()[0] for c in REMOVED.split(", ")] + ["kept"] * texts)
            rows.insert(0, "id", batch["id"].to_numpy() if len(batch) else [])
            yield rows

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, {REMOVED}" + ", kept binary" * texts
    return joined.select("id", "text", "places", "later").mapInPandas(strip, schema).withColumnRenamed("id", id_col)

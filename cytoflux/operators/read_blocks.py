"""Counts of aligned reads' bases by place, with numpy on blocks of reads: the tokens of `alignments.read_bases`, without a row for each of them in Spark.

Reads are dealt to tasks by chunk of the reference and come in order of their chunk, group and cell, so that sums of a place are added up and distinct cells are
counted as they pass: a task holds a block of reads (BASES of their bases, or one read) and the counts of one chunk, however deep it is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoflux.functions.alleles import ALLELES, barcode
from cytoflux.operators.pileup import KINDS, primary
from cytoflux.plans.params import Counting

#: Bases of reads that one task counts, about, and that it holds at a time.
TASK_BASES, BASES = 2_000_000, 500_000
#: No quality; no base (one outside the read's sequence).
MISSING, NO_BASE = -(1 << 40), -1
#: More than the tokens of a task.
TOKENS = 1 << 24
CLASSES = (*ALLELES, "N", "O")
ON_REFERENCE, ON_READ, MATCHED, LETTERS = (np.isin(np.arange(256), [ord(c) for c in s]) for s in ("MDN=X", "MIS=X", "M=X", "MIDNSHP=X"))


def _characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, str]:
    """Code points of all texts, where each begins (and the end), and one text of all. An empty text is one character 0, as Spark splits it into one piece."""
    texts = texts.cast(pa.string()).fill_null("")
    texts = pc.if_else(pc.equal(texts, ""), "\0", texts)
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    starts = np.concatenate([[0], np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))])
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else [0, 0]
    text = texts.buffers()[2][int(ends[0]) : int(ends[-1])].to_pybytes().decode() if ends[-1] > ends[0] else ""
    points = np.frombuffer(text.encode("ascii"), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return points, starts, text


def _operations(cigars: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Read, length and letter of all operations, without hard clips and padding."""
    x, starts, _ = _characters(cigars)
    x = np.minimum(x, 255).astype(np.uint8)
    at, digit = np.arange(len(x)), (x >= 48) & (x <= 57)
    begins = np.zeros(len(x) + 1, bool)
    begins[starts] = True
    before = np.concatenate([[False], digit[:-1]]) & ~begins[:-1]
    run = np.maximum.accumulate(np.where(digit & ~before, at, 0))
    op = np.flatnonzero(LETTERS[x] & before)
    n, length = np.zeros(len(op), np.int64), op - run[op - 1]
    for k in range(length.max(initial=0)):
        n += np.where(length > k, (x[np.maximum(op - 1 - k, 0)].astype(np.int64) - 48) * 10**k, 0)
    kept = ~np.isin(x[op], [ord("H"), ord("P")])
    return np.searchsorted(starts, op[kept], "right") - 1, n[kept], x[op[kept]]


def _before(read: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Sums of the steps of each read's operations before this one."""
    sums = np.cumsum(steps) - steps
    first = np.flatnonzero(np.diff(read, prepend=-1))
    return sums - np.repeat(sums[first], np.diff(np.append(first, len(read)))) if len(read) else sums


class Segments:
    """The operations that give places: read, first place, length, places skipped of it (all but the last of an intron), start on the read, and the one behind."""

    def __init__(self, batch: pa.RecordBatch):
        read, n, op = _operations(batch.column("cigar"))
        to, source = _before(read, np.where(ON_REFERENCE[op], n, 0)), _before(read, np.where(ON_READ[op], n, 0))
        follows = np.append(read[1:] == read[:-1], False) if len(read) else np.zeros(0, bool)
        following = np.where(follows, np.append(op[1:], 0), 0) if len(read) else op
        kept = np.flatnonzero((n > 0) & (MATCHED[op] | (op == ord("D")) | ((op == ord("N")) & (following == ord("I")))))
        self.read, self.n, self.op, self.source, self.behind = read[kept], n[kept], op[kept], source[kept], following[kept]
        self.skipped = np.where(self.op == ord("N"), self.n - 1, 0)
        self.first = batch.column("pos").to_numpy(zero_copy_only=False).astype(np.int64)[self.read] + to[kept]
        after = np.minimum(kept + 1, max(len(n) - 1, 0))
        self.behind_n, self.behind_source = n[after], source[after]


def _chunks(reads: DataFrame, size: int) -> DataFrame:
    """reads with chunk, a row for each chunk of `size` places that they have a place in."""

    def dealt(batches):
        for batch in batches:
            for part in _parts(batch):
                s = Segments(part)
                low, high = (s.first + s.skipped - 1) // size, (s.first + s.n - 2) // size
                chunk, read = _ranges(low, high - low + 1), np.repeat(s.read, high - low + 1)
                order = np.lexsort((chunk, read))
                read, chunk = read[order], chunk[order]
                new = np.append(True, (np.diff(read) != 0) | (np.diff(chunk) != 0)) if len(read) else np.zeros(0, bool)
                rows = part.take(pa.array(read[new]))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(chunk[new], pa.int64())], names=[*part.schema.names, "chunk"])

    schema = ", ".join(f"`{n}` {t}" for n, t in reads.dtypes)
    return reads.mapInArrow(dealt, f"{schema}, chunk long")


def _parts(batch: pa.RecordBatch):
    """The batch in parts of BASES bases, or of one read."""
    ends = np.cumsum(pc.utf8_length(batch.column("seq")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BASES, "right")))
        yield batch.slice(at, to - at)
        at = to


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1 ... of each range."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


class Places:
    """Read, place, quality and token (a number; `tokens` has their texts, None for no base) of a batch of reads inside their chunks."""

    def __init__(self, batch: pa.RecordBatch, size: int):
        s = Segments(batch)
        low = batch.column("chunk").to_numpy(zero_copy_only=False).astype(np.int64)[s.read] * size + 1
        begin = np.maximum(s.skipped, low - s.first)
        counts = np.maximum(np.minimum(s.n, low + size - s.first) - begin, 0)
        k, o = np.repeat(np.arange(len(counts)), counts), _ranges(begin, counts)
        self.read, self.pos = s.read[k], s.first[k] + o
        reverse = batch.column("is_reverse").fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
        bases, starts, text = _characters(batch.column("seq"))
        matched, source = MATCHED[s.op][k], s.source[k] + np.where(MATCHED[s.op][k], o, 0)
        place, ends = starts[self.read] + source, starts[self.read + 1]
        base = np.where(place < ends, bases[np.minimum(place, len(bases) - 1)].astype(np.int64), NO_BASE) if len(bases) else np.full(len(k), NO_BASE)
        self.base = np.where(matched, base, np.where(s.op[k] == ord("D"), ord("*"), np.where(reverse[self.read], ord("<"), ord(">"))))
        behinds, numbers = {"": 0}, np.zeros(len(s.n), np.int64)
        for i in np.flatnonzero((s.behind == ord("I")) | ((s.behind == ord("D")) & (s.op != ord("D")))).tolist():
            m, at = int(s.behind_n[i]), int(starts[s.read[i]] + s.behind_source[i])
            shown = f"+{m}{text[at : min(at + m, int(starts[s.read[i] + 1]))]}" if s.behind[i] == ord("I") else f"-{m}{'N' * m}"
            numbers[i] = behinds.setdefault(shown.replace("\0", ""), len(behinds))
        behind = np.where(o == s.n[k] - 1, numbers[k], 0)
        codes, self.token = np.unique((behind * (1 << 22) + self.base + 1) * 2 + reverse[self.read], return_inverse=True)
        listed = list(behinds)

        def shown(code: int) -> str | None:
            base, tail = (code >> 1) % (1 << 22) - 1, listed[code >> 23]
            token = (chr(base) if base else "") + tail if base != NO_BASE else None
            return token and (token.lower() if code & 1 else token.upper())

        self.tokens = [shown(int(c)) for c in codes]
        self.quality = _quality(batch.column("qual"), self.read, source)


def _quality(quals: pa.Array, read: np.ndarray, source: np.ndarray) -> np.ndarray:
    none = quals.is_null().to_numpy(zero_copy_only=False)
    if pa.types.is_string(quals.type) or pa.types.is_large_string(quals.type):
        values, starts, _ = _characters(quals)
        values = values.astype(np.int64) - 33
    else:
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(quals).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))])
        values = quals.flatten().cast(pa.int64()).fill_null(MISSING).to_numpy(zero_copy_only=False)
    place = starts[read] + source
    known = (place < starts[read + 1]) & ~none[read]
    return np.where(known, values[np.minimum(place, len(values) - 1)], MISSING) if len(values) else np.full(len(read), MISSING)


def token_class(token: str | None) -> str:
    """`alleles.token_class` of a text."""
    if token is None:
        return "NA"
    if len(token) == 1 and token.upper() in "ACTGN":
        return token.upper()
    return {"-": "D", "+": "I"}.get(token[1:2], "O" if token == "*" else "NA")


def _runs(columns: list[pa.Array]) -> np.ndarray:
    """A number for each row, one more where one of the columns changes."""
    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        codes = pc.dictionary_encode(c, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.cumsum(new)


class Passing:
    """Sums by key while rows pass by group and, in it, by cell: those of a group that may go on are held back.

    Behind the sums come the numbers of distinct cells of a key and of those that no smaller key of the same place has (keys // classes), whose sum over
    a place is its number of distinct cells.
    """

    def __init__(self, classes: int = 1):
        self.group = self.cell = self.keys = None
        self.classes = classes

    def add(self, groups: list[tuple], group: np.ndarray, cells: list[tuple], cell_count: int, cell: np.ndarray, key: np.ndarray, counts: np.ndarray, sums: list[np.ndarray]):
        """Yields (group, keys, sums) of groups that are over. groups: the names of their numbers; cells: those of the first one and, if there are others, of the last."""
        span = int(key.max(initial=0)) + 1
        both, inverse = np.unique(group * span + key, return_inverse=True)
        total = np.stack([np.bincount(inverse, weights=s, minlength=len(both)) for s in sums], axis=1).astype(np.int64)
        seen = _distinct(cell[counts] * len(both) + inverse[counts]) if len(both) else np.zeros(0, np.int64)
        whose, what = np.divmod(seen, max(len(both), 1))
        known = both % span
        place = known[what] // self.classes
        first = np.append(True, (np.diff(whose) != 0) | (np.diff(place) != 0)) if len(what) else np.zeros(0, bool)
        if self.cell is not None and cells[0] == self.cell:
            first &= (whose > 0) | ~np.isin(place, self.seen // self.classes)
        firsts = np.bincount(what[first], minlength=len(both))
        if self.cell is not None and cells[0] == self.cell:  # the cell goes on
            old = (whose == 0) & np.isin(known[what], self.seen)
            self.seen = np.union1d(self.seen, known[what[whose == 0]])
            whose, what = whose[~old], what[~old]
        elif len(cells) == 1:
            self.seen = known[what]
        if len(cells) > 1:
            last = int(cell_count) - 1
            self.seen = known[what[whose == last]]
        self.cell = cells[-1]
        total = np.column_stack([total, np.bincount(what, minlength=len(both)), firsts])
        cuts = np.searchsorted(both, np.arange(len(groups) + 1) * span)
        for g, name in enumerate(groups):
            keys, values = known[cuts[g] : cuts[g + 1]], total[cuts[g] : cuts[g + 1]]
            if self.group == name:  # the group goes on
                every, at = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
                summed = np.zeros((len(every), values.shape[1]), np.int64)
                np.add.at(summed, at, np.concatenate([self.values, values]))
                keys, values = every, summed
            elif self.group is not None:
                yield self.group, self.keys, self.values
            self.group, self.keys, self.values = name, keys, values

    def end(self):
        if self.group is not None:
            yield self.group, self.keys, self.values


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def _names(batch: pa.RecordBatch, columns: list[str], runs: np.ndarray) -> list[tuple]:
    rows = pa.array(np.flatnonzero(np.diff(runs, prepend=-1)))
    return list(zip(*(batch.column(c).take(rows).to_pylist() for c in columns), strict=True))


def _ends(batch: pa.RecordBatch, columns: list[str], runs: np.ndarray) -> list[tuple]:
    """The names of the first run and, if there are others, of the last."""
    rows = [0, batch.num_rows - 1] if runs[-1] else [0]
    return [tuple(batch.column(c)[r].as_py() for c in columns) for r in rows]


def _dealt(reads: DataFrame, size: int, keep: list[str]) -> tuple[DataFrame, int]:
    known = reads.where(F.col("pos").isNotNull() & F.col("cigar").isNotNull() & F.col("seq").isNotNull() & (F.col("seq") != "*")).select(*keep)
    tasks = max(1, -(-(known.agg(F.sum(F.length("seq"))).first()[0] or 0) // TASK_BASES))
    return _chunks(known, size), tasks


def count_tokens(reads: DataFrame, size: int, group: str = "sample_id") -> DataFrame:
    """group, chrom, pos, raw_base, n, bq (the sum of qualities), nc (distinct cells) of `alignments.read_bases`."""
    dealt, tasks = _dealt(reads, size, [group, "cb", "chrom", "pos", "cigar", "seq", "qual", "is_reverse"])
    ordered = dealt.repartition(tasks, "chrom", "chunk").sortWithinPartitions("chrom", "chunk", group, "cb")
    names = ["chrom", "chunk", group]

    def counted(batches):
        passing, texts, ids, group_type = Passing(), [], {}, None

        def rows(found):
            found = list(found)
            if not found:
                return
            keys, values = np.concatenate([k for _, k, _ in found]), np.concatenate([v for *_, v in found])
            offset, token = np.divmod(keys, TOKENS)
            whose = pa.array(np.repeat(np.arange(len(found)), [len(k) for _, k, _ in found]))
            chrom, chunk, name = (list(x) for x in zip(*(g for g, *_ in found), strict=True))
            used, token = np.unique(token, return_inverse=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(name, group_type).take(whose), pa.array(chrom, pa.string()).take(whose), pa.array(offset + np.array(chunk, np.int64)[whose] * size + 1, pa.int64()), pa.array([texts[t] for t in used], pa.string()).take(pa.array(token)),
                pa.array(values[:, 0]), pa.array(values[:, 1], mask=values[:, 2] == 0), pa.array(values[:, 3]),
            ], names=[group, "chrom", "pos", "raw_base", "n", "bq", "nc"])

        for batch in batches:
            group_type = batch.schema.field(group).type
            for part in _parts(batch):
                p = Places(part, size)
                numbers = np.array([ids.setdefault(t, len(ids)) for t in p.tokens], np.int64)
                texts = list(ids)
                by_group, by_cell = _runs([part.column(c) for c in names]), _runs([part.column(c) for c in (*names, "cb")])
                known, has_cell = p.quality != MISSING, part.column("cb").is_valid().to_numpy(zero_copy_only=False)
                key = (p.pos - 1) % size * TOKENS + (numbers[p.token] if len(numbers) else 0)
                sums = [np.ones(len(key)), np.where(known, p.quality, 0), known]
                yield from rows(passing.add(_names(part, names, by_group), by_group[p.read], _ends(part, [*names, "cb"], by_cell), by_cell.max(initial=-1) + 1, by_cell[p.read], key, has_cell[p.read], sums))
        yield from rows(passing.end())

    return ordered.mapInArrow(counted, f"`{group}` {dict(reads.dtypes)[group]}, chrom string, pos long, raw_base string, n long, bq long, nc long")


def count_pileup(reads: DataFrame, size: int, chunks: DataFrame, params: Counting | None = None, flank: int = 5) -> DataFrame:
    """`pileup.count_bases` of the bases of reads: chrom, pos, ref, cell_type, dp, nc and, by allele, cc, bc, bq, bcf, bcr (arrays).

    chunks: see `calling.reference_context`; places without a reference are not counted. params: without max_depth.
    """
    params = params or Counting()
    if params.max_depth is not None:
        raise ValueError("a greatest depth needs rows: pileup.count_bases")
    own = reads.where(F.col("map_qual") >= params.min_mq).withColumn("cb", barcode(F.col("cb")))
    own = own.withColumn("used", F.coalesce(primary() & F.col("cb").isNotNull() & F.col("cell_type").isNotNull(), F.lit(False)))
    dealt, tasks = _dealt(own, size, ["cell_type", "cb", "chrom", "pos", "cigar", "seq", "qual", "is_reverse", "used"])
    both = dealt.unionByName(chunks.select("chrom", "chunk", F.col("seq").alias("ref_seq")), allowMissingColumns=True)
    ordered = both.repartition(tasks, "chrom", "chunk").sortWithinPartitions("chrom", "chunk", F.col("ref_seq").isNull(), "cell_type", "cb")
    names = ["chrom", "chunk", "cell_type"]
    letters = np.array([ord(c) for c in ALLELES])

    def counted(batches):
        passing, refs = Passing(len(CLASSES)), {}

        def of(chrom, chunk, offsets):
            """Reference bases, upper-case; N where there is none."""
            x = refs.get((chrom, chunk))
            at = offsets + (flank if chunk > 0 else 0)
            return np.where(at < len(x), x[np.minimum(at, len(x) - 1)], ord("N")) if x is not None and len(x) else np.full(len(at), ord("N"))

        def rows(found):
            kept = []
            for (chrom, chunk, cell_type), keys, values in found:
                if cell_type is None:
                    continue
                place, kind = np.divmod(keys, len(CLASSES))
                offsets, at = np.unique(place, return_inverse=True)
                table = np.zeros((len(offsets), len(CLASSES), values.shape[1]), np.int64)
                table[at, kind] = values
                dp, tokens, nc, ref = table[:, :, 1].sum(axis=1), table[:, :, 0].sum(axis=1), table[:, :, 6].sum(axis=1), of(chrom, chunk, offsets)
                ac = np.where(ref[:, None] != letters, table[:, : len(ALLELES), 0], 0).sum(axis=1)
                good = (tokens >= params.min_dp) & (ac >= params.min_ac) & (dp >= params.min_dp) & (nc >= params.min_cc) & (ref != ord("N"))
                if good.any():
                    table = table[good, : len(ALLELES)]
                    kept.append((chrom, cell_type, offsets[good] + chunk * size + 1, ref[good], dp[good], nc[good], *(table[:, :, k] for k in (5, 1, 2, 4, 3))))
            if kept:
                chrom, cell_type, *columns = zip(*kept, strict=True)
                whose = pa.array(np.repeat(np.arange(len(kept)), [len(x) for x in columns[0]]))
                pos, ref, dp, nc, *tables = (np.concatenate(c) for c in columns)
                ends = pa.array(np.arange(len(pos) + 1) * len(ALLELES), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array(chrom, pa.string()).take(whose), pa.array(pos), pa.array([chr(c) for c in ref.tolist()], pa.string()), pa.array(cell_type, pa.string()).take(whose), pa.array(dp), pa.array(nc),
                    *[pa.ListArray.from_arrays(ends, pa.array(t.reshape(-1))) for t in tables],
                ], names=["chrom", "pos", "ref", "cell_type", "dp", "nc", *KINDS])

        for batch in batches:
            marks = batch.column("ref_seq").is_valid()
            marked = batch.filter(marks)
            for chrom, chunk, seq in zip(*(marked.column(c).to_pylist() for c in ("chrom", "chunk", "ref_seq")), strict=True):
                refs[chrom, chunk] = np.array([ord(c) for c in seq.upper()], np.int64) if not seq.isascii() else np.frombuffer(seq.upper().encode(), np.uint8).astype(np.int64)
            for part in _parts(batch.filter(pc.invert(marks))):
                p = Places(part, size)
                kinds = np.array([CLASSES.index(c) if (c := token_class(t)) != "NA" else len(CLASSES) for t in p.tokens], np.int64)
                kind = kinds[p.token] if len(kinds) else p.token
                good = (kind < len(CLASSES)) & (p.quality != MISSING) & (p.quality >= params.min_bq)
                read, kind, pos, quality = p.read[good], kind[good], p.pos[good], p.quality[good]
                by_group, by_cell = _runs([part.column(c) for c in names]), _runs([part.column(c) for c in (*names, "cb")])
                used, reverse = (part.column(c).fill_null(False).to_numpy(zero_copy_only=False).astype(bool)[read] for c in ("used", "is_reverse"))
                stranded = part.column("is_reverse").is_valid().to_numpy(zero_copy_only=False)[read]
                sums = [np.ones(len(read)), used, np.where(used, quality, 0), used & reverse, used & stranded & ~reverse]
                yield from rows(passing.add(_names(part, names, by_group), by_group[read], _ends(part, [*names, "cb"], by_cell), by_cell.max(initial=-1) + 1, by_cell[read], (pos - 1) % size * len(CLASSES) + kind, used, sums))
            # A group that may go on is of the last chunk that reads have come for; later ones have no reads yet.
            for key in list(refs):
                if passing.group is not None and key != passing.group[:2] and (not marked.num_rows or key != (marked.column("chrom")[-1].as_py(), marked.column("chunk")[-1].as_py())):
                    del refs[key]
        yield from rows(passing.end())

    return ordered.mapInArrow(counted, "chrom string, pos long, ref string, cell_type string, dp long, nc long, " + ", ".join(f"{k} array<bigint>" for k in KINDS))

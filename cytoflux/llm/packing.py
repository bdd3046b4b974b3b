"""Packing documents into sequences of bounded length, in their order, by dynamic programming.

The documents of a partition, one behind the other, are a stream of token ids that is cut into windows of at most
`size` ids. A cut at the end of a document is free, one at the end of a sentence costs SENTENCE padding ids, one inside
a long sentence INSIDE; a window costs the ids that pad it, none if it is as long as a power of two, and WINDOW. The cheapest
cuts follow from

    best[j] = cut[j] + WINDOW + min(best[i] + size - (p[j] - p[i]) over p[j] - size <= p[i] < p[j], best[i] over p[j] - p[i] = 2^k)

where the first minimum is the head of a monotone queue of best[i] + p[i]. Every place enters and leaves the queue
once, so that the time is linear in the places.

A partition is packed by itself, in the order in which Spark reads it: no text is shuffled, a lost task is packed again alike, and
at most one window of each partition lacks a successor. The stream is settled a segment at a time, so that the ids of
a segment (or of one long document) are all that a task holds.
"""

from __future__ import annotations

import array
import os
import re
import unicodedata
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

SIZE = 1024
TOKENIZER = "byte_bpe_50k.json"
#: Costs, in ids of padding.
SENTENCE, INSIDE, WINDOW = 6, 24, 8
#: A sentence longer than LONG may be cut at every STEP ids.
LONG, STEP = 96, 32
#: Ids that are packed at once.
SEGMENT = 1 << 20
#: Pieces of text whose ids a worker remembers, and documents that are looked up at once.
REMEMBERED, TEXTS = 3 << 19, 256
END_OF_DOCUMENT = 0
END_RAW = array.array("I", [END_OF_DOCUMENT]).tobytes()


def _ranges(kind: str) -> str:
    """A class of those characters up to U+024F and of the general punctuation that are letters, numbers or spaces."""
    is_kind = {"L": lambda c: unicodedata.category(c)[0] == "L", "N": lambda c: unicodedata.category(c)[0] == "N", "S": lambda c: c.isspace() and c not in "\x1c\x1d\x1e\x1f"}[kind]
    return "".join(f"\\u{i:04x}" for i in [*range(0x250), *range(0x2000, 0x2070)] if is_kind(chr(i)))


#: Other characters than these leave the splitting of a text to the tokenizer.
OTHER = re.compile("[^\x00-ɏ -⁯]")
#: Fixed pattern of byte-level BPE: contractions, words, numbers, signs and white space.
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+".format(**{k: _ranges(k) for k in "LNS"}))
SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids of texts by a byte-level BPE tokenizer, which encodes every distinct piece of text once.

    Such a tokenizer splits a text by `PIECES` and encodes the pieces one by one: known ones are looked up, new ones go to it together.
    A text that holds the special token or characters outside `OTHER`'s ranges is encoded as a whole.
    """

    _loaded: dict[str, Encoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer, self.pieces = Tokenizer.from_file(path), {}
        texts = [self.tokenizer.decode([i], skip_special_tokens=False) for i in range(self.tokenizer.get_vocab_size())]
        #: Per id: a sentence may end behind it; it holds a line break; it starts with white space; with a space.
        self.ends = np.array([t.rstrip().rstrip("\"')]”’»").endswith((".", "!", "?", "…", "。", "！", "？")) for t in texts])
        self.breaks = np.array(["\n" in t for t in texts])
        self.starts = np.array([t[:1].isspace() for t in texts])
        self.spaced = np.array([t[:1] == " " for t in texts])

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _learn_pieces(self, pieces: set[str]) -> None:
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        new = pieces.difference(self.pieces)
        words = [p for p in new if p[0] == " " and p[1:].isalpha()]
        # Words with their spaces fall apart into the same pieces again, and only a word's first id starts with a space.
        ids = np.array(self.tokenizer.encode("".join(words), add_special_tokens=False).ids, "<u4")
        raw, edges = ids.tobytes(), (4 * np.append(np.flatnonzero(self.spaced[ids]), len(ids))).tolist()
        self.pieces.update(zip(words, (raw[a:b] for a, b in zip(edges, edges[1:])), strict=True))
        others = list(new.difference(words))
        self.pieces.update((p, array.array("I", e.ids).tobytes()) for p, e in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True))

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        pieces = [PIECES.findall(t) for t in texts]
        self._learn_pieces(set().union(*pieces))
        return [b"".join(map(self.pieces.__getitem__, p)) for p in pieces]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, then `END_OF_DOCUMENT`."""
        plain = [k for k, t in enumerate(texts) if SPECIAL not in t and (t.isascii() or not OTHER.search(t))]
        raw: list[bytes | None] = [None] * len(texts)
        for k, of_text in zip(plain, self._by_pieces([texts[k] for k in plain]), strict=True):
            raw[k] = of_text
        for k, text in enumerate(texts):
            if raw[k] is None:
                raw[k] = array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return [np.frombuffer(r + END_RAW, "<u4") for r in raw]

    def sentence_ends(self, ids: np.ndarray) -> np.ndarray:
        """Numbers of ids behind which a sentence ends: an id that ends one, then white space; or a line break."""
        return np.flatnonzero((self.ends[ids[:-1]] & self.starts[ids[1:]]) | self.breaks[ids[:-1]]) + 1


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])]


def places(sentences: np.ndarray, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a stream may be cut, 0 and its end included, and what each cut costs, from the ends of its sentences and documents."""
    edges = _distinct(np.concatenate([[0], sentences, documents]))
    gaps = np.diff(edges)
    long = np.flatnonzero(gaps > LONG)
    inside = (gaps[long] - 1) // STEP
    nth = np.arange(inside.sum()) - np.repeat(np.cumsum(inside) - inside, inside)
    edges = np.sort(np.concatenate([edges, np.repeat(edges[long], inside) + STEP * (nth + 1)]))
    cost = np.full(len(edges), INSIDE)
    cost[np.searchsorted(edges, sentences)] = SENTENCE
    cost[np.searchsorted(edges, documents)] = cost[0] = 0
    return edges, cost


def cheapest(p: np.ndarray, cost: np.ndarray, size: int, last: bool) -> np.ndarray:
    """The cuts of least cost among the places p (ascending, from 0 on, at most `size` apart).

    last: the final place is a cut; else the cheapest place of the final window is the last cut.
    """
    n = len(p)
    exact: list[tuple[np.ndarray, np.ndarray]] = []
    for k in range(size.bit_length()):
        at = np.searchsorted(p, p - (1 << k))
        hit = np.flatnonzero((p >= 1 << k) & (p[np.minimum(at, n - 1)] == p - (1 << k)))
        exact.append((hit, at[hit]))
    to, frm = np.concatenate([h for h, _ in exact]), np.concatenate([a for _, a in exact])
    order = np.argsort(to, kind="stable")
    first = np.searchsorted(to[order], np.arange(n + 1)).tolist()
    frm, at, fee = frm[order].tolist(), p.tolist(), cost.tolist()
    best, back, key = [0] * n, [0] * n, [0] * n
    queue: deque[int] = deque([0])
    for j in range(1, n):
        here = at[j]
        while at[queue[0]] < here - size:
            queue.popleft()
        i = queue[0]
        least = key[i] + size - here
        for x in frm[first[j] : first[j + 1]]:
            if best[x] < least:
                least, i = best[x], x
        best[j], back[j] = least + fee[j] + WINDOW, i
        mine = key[j] = best[j] + here
        while queue and key[queue[-1]] >= mine:
            queue.pop()
        queue.append(j)
    j = n - 1
    if not last:
        final = int(np.searchsorted(p, p[-1] - size, "right"))
        j = min(range(max(final, 1), n), key=lambda x: (best[x], -x))
    cuts = [j]
    while j:
        j = back[j]
        cuts.append(j)
    return p[cuts[::-1]]


class Stream:
    """The documents that a task has read and not yet packed: doc_id, ids before the rest, the rest, and how many ids it has."""

    def __init__(self, encoder: Encoder, size: int, first_sequence: int):
        self.encoder, self.size, self.next = encoder, size, first_sequence
        self.held: list[tuple[object, int, np.ndarray, int]] = []
        self.waiting = 0

    def add(self, doc_id: object, ids: np.ndarray) -> None:
        self.held.append((doc_id, 0, ids, len(ids)))
        self.waiting += len(ids)

    def settle(self, last: bool) -> list[tuple]:
        """The pieces of the windows that are settled: all if no document follows, else all but the last window's rest."""
        if not self.held:
            return []
        sizes = np.array([len(h[2]) for h in self.held])
        starts = np.cumsum(sizes) - sizes
        p, cost = places(self.encoder.sentence_ends(np.concatenate([h[2] for h in self.held])), starts + sizes)
        cuts = cheapest(p, cost, self.size, last)
        edges = _distinct(np.concatenate([starts[starts < cuts[-1]], cuts]))
        document = np.searchsorted(starts, edges[:-1], "right") - 1
        window = np.searchsorted(cuts, edges[:-1], "right") - 1
        out = []
        for a, b, d, w in zip(edges[:-1].tolist(), edges[1:].tolist(), document.tolist(), window.tolist(), strict=True):
            doc_id, before, ids, total = self.held[d]
            at = int(starts[d])
            out.append((doc_id, before + a - at, b - a, zlib.crc32(ids[a - at : b - at]), total, self.next + w, a - int(cuts[w])))
        self.next += len(cuts) - 1
        cut = int(cuts[-1])
        rest = int(np.searchsorted(starts + sizes, cut, "right"))
        held = self.held[rest:]
        if held and starts[rest] < cut:
            doc_id, before, ids, total = held[0]
            gone = cut - int(starts[rest])
            held[0] = (doc_id, before + gone, ids[gone:], total)
        self.held, self.waiting = held, int(sizes.sum()) - cut
        return out


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, tokenizer: str | None = None, size: int = SIZE, segment: int = SEGMENT) -> DataFrame:
    """One row per piece of a document: doc_id, start (ids of the document before it), length, ids_crc32 (of the ids as
    little-endian 32-bit numbers), doc_tokens (all ids of the document), sequence_id and offset (the piece's place there).

    tokenizer: path of a byte-level BPE tokenizer's file, on every executor. Each document is its ids, then 0; each id lies in exactly one piece; pieces
    of a sequence follow each other without a gap. A null or empty text is the id 0 alone; null and repeated ids and rows are documents like others;
    very long texts span sequences; columns other than doc_id and text are not looked at; an empty table gives no rows. sequence_id: partition * 2^33 + number.
    """
    if size < 2 * LONG:
        raise ValueError(f"size is at least {2 * LONG}")
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    kind = docs.schema["doc_id"].dataType
    schema = ", ".join([f"doc_id {kind.simpleString()}", *(f"{c} long" for c in COLUMNS[1:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        stream, of_ids = Stream(encoder, size, TaskContext.get().partitionId() << 33), None

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*pieces, strict=True)) or [()] * len(COLUMNS)
            return pa.RecordBatch.from_arrays([pa.array(columns[0], of_ids), *(pa.array(c, pa.int64()) for c in columns[1:])], COLUMNS)

        for batch in batches:
            of_ids = batch.schema.field("doc_id").type
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                texts = [t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()]
                for doc_id, ids in zip(part.column(part.schema.get_field_index("doc_id")).to_pylist(), encoder.encode(texts), strict=True):
                    stream.add(doc_id, ids)
                    if stream.waiting >= segment:
                        yield rows(stream.settle(False))
        if of_ids is not None:
            yield rows(stream.settle(True))

    return docs.select("doc_id", "text").mapInArrow(run, schema)

"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs (lines between blank ones) are cut into overlapping pieces of several lengths, each a sparse vector of
hashed word uni- and bigrams. Softmax regression over the licence families and `unknown` gives each piece calibrated
probabilities; every family that competes with `unknown` somewhere is then sought there. A template is confirmed where its
key phrases stand word by word, enough of its words stand in order around them, and no negation stands in front; families
that share most of their notice (GPL, LGPL and AGPL, the Creative Commons ones) differ in their key phrases. No piece is
passed over: only the model's weights decide where to look.

The model learns from noisy copies of the templates, from texts that only talk about licences, and, as `unknown`,
from a bounded sample of the documents' own pieces without a template (`SAMPLE`). The temperature is fitted on other
pieces of the documents, labelled by template comparison, and on other copies.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS, SEED = 12, 11
DIMS = 1 << BITS
EPOCHS, RATE, DECAY = 30, 0.5, 1e-5
#: Lengths of the pieces, in words; each begins half a length after the one before.
SIZES = (8, 16, 40)
#: Share of a family against unknown from which it is sought, least one for its own words, and least share of a
#: template that must be found.
PROPOSED, CONFIDENT, CONFIRMED = 0.2, 0.6, 0.7
#: Documents of which one piece each is learned from, or calibrated with.
SAMPLE = 2000
UNKNOWN = "unknown"
#: Words of the text more than a template has in which it must stand.
SLACK = 8
#: Fixed texts: the notices by which each family is named or granted, public texts of the licences. Key phrases are in brackets; # is any version number.
TEMPLATES = {
    "agpl": ["this program is free software you can redistribute it and or modify it under the terms of the [gnu affero general public license] as published by the free software foundation", "licensed under the [gnu affero general public license]", "licensed under the [agpl]"],
    "apache-2.0": ["licensed under the [apache license version 2.0]", "licensed under the [apache license 2.0]", "licensed under the [apache 2.0] license", "you may not use this file except in compliance with the license you may obtain a copy of the license at [www apache org licenses] license 2.0", "you may not use this file except [in compliance with the license] you may obtain a copy of the license at", "unless required by applicable law or agreed to in writing software [distributed under the license is distributed on an as is basis]"],
    "boost": ["permission is hereby granted free of charge to any [person or organization obtaining a copy] of the software and accompanying documentation covered by this license", "distributed under the [boost software license] version 1.0"],
    "bsd": ["[redistribution and use in source and binary forms] with or without modification are permitted provided that the following conditions are met", "redistributed under the terms of the [bsd license]", "released under the [bsd # clause] license", "this source code is licensed under the [bsd style license] found in the license file"],
    "cc-by": ["licensed under [cc by #]", "this work is licensed under a [creative commons attribution #] international license"],
    "cc-by-nc": ["licensed under [cc by nc #]", "this work is licensed under a [creative commons attribution noncommercial #] international license"],
    "cc-by-nc-nd": ["licensed under [cc by nc nd #]", "this work is licensed under a [creative commons attribution noncommercial noderivatives #] international license", "this work is licensed under a [creative commons attribution noncommercial noderivs #] license"],
    "cc-by-nc-sa": ["licensed under [cc by nc sa #]", "this work is licensed under a [creative commons attribution noncommercial sharealike #] international license"],
    "cc-by-nd": ["licensed under [cc by nd #]", "this work is licensed under a [creative commons attribution noderivatives #] international license", "this work is licensed under a [creative commons attribution noderivs #] license"],
    "cc-by-sa": ["licensed under [cc by sa #]", "this work is licensed under a [creative commons attribution sharealike #] international license"],
    "cc0": ["to the extent possible under law the author has [waived all copyright and related or neighboring rights] to this work", "dedicated to the public domain under [cc0]", "this work is marked with [cc0 1.0]"],
    "epl": ["this program and the accompanying materials are made available under the terms of the [eclipse public license]", "licensed under the [eclipse public license]"],
    "gpl": ["this program is free software you can redistribute it and or modify it under the terms of the [gnu general public license] as published by the free software foundation", "this work is licensed under the [gnu general public license]", "you should have received a copy of the [gnu general public license] along with this program"],
    "gpl-2.0": ["this program is free software you can redistribute it and or modify it under the terms of the [gnu general public license] as published by the free software foundation either [version 2] of the license or at your option any later version", "this work is licensed under the [gnu general public license version 2]", "under the terms of the [gnu general public license version 2] as published by the free software foundation", "licensed under the [gpl v2]", "licensed under the [gplv2]"],
    "gpl-3.0": ["this program is free software you can redistribute it and or modify it under the terms of the [gnu general public license] as published by the free software foundation either [version 3] of the license or at your option any later version", "this work is licensed under the [gnu general public license version 3]", "under the terms of the [gnu general public license version 3] as published by the free software foundation", "licensed under the [gpl v3]", "licensed under the [gplv3]"],
    "isc": ["permission to use copy modify and or distribute this software for any purpose [with or without fee is hereby granted] provided that the above copyright notice and this permission notice appear in all copies", "licensed under the [isc license]"],
    "lgpl": ["this library is free software you can redistribute it and or modify it under the terms of the [gnu lesser general public license] as published by the free software foundation", "you can redistribute it and or modify it under the terms of the [gnu library general public license]", "licensed under the [gnu lesser general public license]", "you should have received a copy of the [gnu lesser general public license] along with this library", "licensed under the [lgpl]"],
    "mit": ["released under the [mit license]", "permission is hereby granted free of charge to any [person obtaining a copy of this software and associated documentation files] the software to deal in the software without restriction", "[permission is hereby granted free of charge to any person obtaining a copy] of this software and associated documentation files the software to deal in the software without restriction"],
    "mpl-2.0": ["this source code form is subject to the terms of the [mozilla public license v 2.0]", "licensed under the [mozilla public license version 2.0]", "subject to the terms of the [mozilla public license] version 2.0"],
    "proprietary": ["[all rights reserved]", "[no part of this publication may be reproduced] without prior written permission", "unauthorized copying of this file is [strictly prohibited] proprietary and confidential"],
    "unlicense": ["this is [free and unencumbered software] released into the public domain", "anyone is free to copy modify publish use compile sell or distribute this software either in [source code form or as a compiled binary] for any purpose commercial or non commercial and by any means", "released under the [unlicense]"],
}
#: Fixed identifiers of SPDX lines.
IDENTIFIERS = {
    "agpl": ["agpl 3.0"], "apache-2.0": ["apache 2.0"], "boost": ["bsl 1.0"], "bsd": ["bsd 2 clause", "bsd 3 clause", "0bsd"], "cc-by": ["cc by #"], "cc-by-nc": ["cc by nc #"], "cc-by-nc-nd": ["cc by nc nd #"],
    "cc-by-nc-sa": ["cc by nc sa #"], "cc-by-nd": ["cc by nd #"], "cc-by-sa": ["cc by sa #"], "cc0": ["cc0 1.0"], "epl": ["epl #"], "gpl-2.0": ["gpl 2.0"], "gpl-3.0": ["gpl 3.0"], "isc": ["isc"], "lgpl": ["lgpl #"], "mit": ["mit"],
    "mpl-2.0": ["mpl 2.0"], "unlicense": ["unlicense"],
}
#: Words that, between the NEAR ones in front of a match and its last key phrase, make it no grant, if the template hasn't got them.
NEGATIONS, NEAR = frozenset("not no never neither nor without isn aren wasn cannot".split()), 3
#: Words that every notice uses, so that they say nothing by themselves.
RESERVED = "all rights reserved"
#: Sentences without a grant.
OTHERS = ["you need a license to drive a car", "the license of the driver was taken away", "software and files are copied every night", "the public works were permitted by the city", "terms and conditions of the offer apply", "the general was free to speak in public", "version two of the program is out", "creative people and common sense", "a copy of the report was sent to the author", "the rights of all people were reserved for them", "the work of the foundation is published", "permission was granted to enter the building"]
WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)?")


def words(paragraph: str) -> list[str]:
    return WORD.findall(paragraph.lower())


VERSION = re.compile(r"\d+(?:\.\d+)?")


class Template:
    """A family's notice: its words, its key phrases (runs of places in it), and the words that choose where to look."""

    def __init__(self, family: str, text: str):
        self.family, self.text, self.keys, self.words = family, text.replace("[", "").replace("]", ""), [], []
        for k, part in enumerate(re.split(r"[\[\]]", text)):
            of_part = part.split()
            if k % 2:
                self.keys.append((len(self.words), len(self.words) + len(of_part)))
            self.words += of_part
        self.bits = {w: sum(1 << j for j, v in enumerate(self.words) if v == w) for w in set(self.words)}
        self.any_version = "#" in self.bits
        assert not self.any_version or not any(map(VERSION.fullmatch, self.words)), "a version number and # in one template"

    def fits(self, tokens: list[str]) -> bool:
        """Whether the longest common subsequence is long enough, by Hyyro's bit-parallel recurrence."""
        n, row = len(self.words), (1 << len(self.words)) - 1
        for w in tokens:
            m = self.bits.get(w, 0) & row
            row = ((row + m) | (row - m)) & ((1 << n) - 1)
        return n - row.bit_count() >= CONFIRMED * n


ALL_TEMPLATES = [Template(f, t) for f, some in TEMPLATES.items() for t in some] + [Template(f, f"[spdx license identifier {i}]") for f, some in IDENTIFIERS.items() for i in some]
#: Words of the key phrases, and the templates of each family.
KEY_WORDS = frozenset(w for t in ALL_TEMPLATES for a, b in t.keys for w in t.words[a:b])
BY_FAMILY = {f: [t for t in ALL_TEMPLATES if t.family == f] for f in TEMPLATES}


@lru_cache(maxsize=1 << 18)
def _hash(word: str) -> int:
    return zlib.crc32(word.encode())


def slots(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the unigrams, and of the bigrams."""
    h = np.fromiter(map(_hash, tokens), np.uint32, len(tokens))
    pairs = (h[:-1] * np.uint32(0x9E3779B1)) ^ (h[1:] * np.uint32(0x85EBCA77))
    return (h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS), pairs >> np.uint32(32 - BITS)


@lru_cache(maxsize=1 << 12)
def pieces(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end token of the pieces of n tokens: of every length up to the first that holds them all."""
    spans = []
    for size in SIZES:
        spans += [(a, min(a + size, n)) for a in {*range(0, max(n - size, 0) + 1, size // 2), max(n - size, 0)}]
        if size >= n:
            break
    spans.sort()
    return np.array([a for a, _ in spans], int), np.array([e for _, e in spans], int)


def _noisy(rng: random.Random, tokens: list[str], noise: list[str]) -> list[str]:
    out = [t for t in tokens if rng.random() > 0.08]
    return [rng.choice(noise) for _ in range(rng.randrange(0, 5))] + out + [rng.choice(noise) for _ in range(rng.randrange(0, 12))]


def _examples(rng: random.Random, per_class: int) -> list[tuple[list[str], str]]:
    """Generated pieces: noisy copies of the templates, and others that use some of their words."""
    syllables = ["an", "be", "con", "der", "en", "fa", "ti", "on", "re", "la", "que", "ou"]
    noise = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(400)] + "the of and to in is that it for as with was on by".split()
    some = [w for t in ALL_TEMPLATES for w in t.words if w != "#"]
    out = []
    for _ in range(per_class):
        out += [(_noisy(rng, [rng.choice(("3.0", "4.0")) if w == "#" else w for w in rng.choice(t).words], noise), family) for family, t in sorted(BY_FAMILY.items())]
        base = words(rng.choice(OTHERS)) if rng.random() < 0.5 else [rng.choice(noise) for _ in range(rng.randrange(1, 30))]
        out.append((_noisy(rng, base, noise) + [rng.choice(some) for _ in range(rng.randrange(0, 3))], UNKNOWN))
    return out


class Model:
    """Weights of the families, of a fixed size, and the temperature."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, temperature: float, families: list[str]):
        self.weights, self.bias, self.temperature, self.families = weights, bias, temperature, families

    def probabilities(self, tokens: list[str], first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of the families for each piece tokens[first:end], by sums up to each token."""
        upto = []
        for s in slots(tokens):
            upto.append(np.zeros((len(s) + 1, len(self.families))))
            np.cumsum(self.weights[s], 0, out=upto[-1][1:])
        z = upto[0][end] - upto[0][first] + upto[1][np.maximum(end - 1, first)] - upto[1][first]
        z = (z / np.sqrt(np.maximum(2 * (end - first) - 1, 1))[:, None] + self.bias) / self.temperature
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def whole(self, tokens: list[str]) -> np.ndarray:
        return self.probabilities(tokens, np.array([0]), np.array([len(tokens)]))[0]


def background(docs: DataFrame, id_col: str = "doc_id", sample: int = SAMPLE) -> list[list[str]]:
    """The words of one piece each of about `sample` documents, chosen by a hash of id and text; few kB on the driver."""
    n = docs.count()
    hashed = docs.where(F.col("text").isNotNull()).select(F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.md5("text"))).alias("h"), F.lower("text").alias("text"))
    part = lambda first, n: F.conv(F.substring("h", first, n), 16, 10).cast("double") / float(1 << 4 * n)
    of = F.filter(F.split("text", r"[^a-z0-9.]+"), lambda w: w != "")
    chosen = hashed.where(part(1, 8) < sample / max(n, 1)).select("h", of.alias("of"))
    at = F.floor(part(9, 8) * F.greatest(F.size("of") - max(SIZES) + 1, F.lit(1))).cast("int") + 1
    rows = chosen.select("h", F.array_join(F.slice("of", at, max(SIZES)), " ").alias("piece")).orderBy("h").limit(2 * sample).collect()
    return [t for t in (words(r["piece"]) for r in rows) if t]


def occurrences(phrase: list[str], places: dict[str, list[int]], tokens: list[str]) -> list[int]:
    """Where the phrase begins in the tokens, whose places are listed by word."""
    rarest = min(range(len(phrase)), key=lambda j: len(places.get(phrase[j], ())))
    return [i - rarest for i in places.get(phrase[rarest], ()) if i >= rarest and tokens[i - rarest : i - rarest + len(phrase)] == phrase]


def matches(tokens: list[str], templates: list[Template], allowed=None) -> list[tuple[str, int, int, int]]:
    """family, first and last place, and words of the templates' matches that nothing denies. allowed(template, place): whether to look there."""
    plain: dict[str, list[int]] = {}
    for i, w in enumerate(tokens):
        if w in KEY_WORDS or w[0] in "0123456789":
            plain.setdefault(w, []).append(i)
    shown, versions = list(tokens), sorted(i for w, at in plain.items() if VERSION.fullmatch(w) for i in at)
    for i in versions:
        shown[i] = "#"
    numbered = plain | {"#": versions}
    out = []
    for t in templates:
        text, places = (shown, numbered) if t.any_version else (tokens, plain)
        n, upto = len(t.words), 0
        begin, end = t.keys[-1]
        for at in occurrences(t.words[begin:end], places, text):
            # A place before upto belongs to the template's match before.
            if at < upto or (allowed is not None and not allowed(t, at)):
                continue
            low, high = max(upto, at - begin - SLACK), min(len(text), at + n - begin + SLACK)
            piece = text[low:high]
            if not t.fits(piece):
                continue
            if any(not _stands(t.words[a:b], text[low : at + 1 + b - a]) for a, b in t.keys[:-1]):
                continue
            found = [low + x for x in in_order(t.words, piece)]
            first, last = min(found[0], at), max(found[-1], at + end - begin - 1)
            if any(w in NEGATIONS and w not in t.bits for w in tokens[max(first - NEAR, 0) : at]):
                continue
            out.append((t.family, first, last, len(found)))
            upto = last + 1
    return out


def _stands(phrase: list[str], tokens: list[str]) -> bool:
    n = len(phrase)
    return any(tokens[i : i + n] == phrase for i in range(len(tokens) - n + 1))


def settled(found: list[tuple[str, int, int, int]], tokens: list[str]) -> list[tuple[str, int, int, int]]:
    """Matches that are no part of a longer one.

    A match between the ends of a match of more words is that one (another family's, if it is); reserved rights alone
    are none beside a granted licence. One sweep in order of the places: a match spans no more than a template and SLACK.
    """
    found = sorted(set(found), key=lambda m: (m[1], -m[2], m[0]))
    reach, start, out = max(len(t.words) for t in ALL_TEMPLATES) + 2 * SLACK, 0, []
    for family, low, high, n in found:
        while found[start][1] < low - reach:
            start += 1
        inside = False
        for k in range(start, len(found)):
            other, a, b, more = found[k]
            if a > low:
                break
            if b >= high and more > n:
                inside = True
                break
        if not inside:
            out.append((family, low, high, n))
    if any(f != "proprietary" for f, *_ in out):
        out = [m for m in out if " ".join(tokens[m[1] : m[2] + 1]) != RESERVED]
    return out


def found_in(tokens: list[str]) -> set[str]:
    """The families of which a template stands in the tokens, by comparison alone."""
    return {m[0] for m in settled(matches(tokens, ALL_TEMPLATES), tokens)}


def train(pieces_of_documents: list[list[str]] | tuple = (), per_class: int = 120) -> Model:
    """Stochastic gradient descent on generated pieces and on half of the given ones; the others calibrate."""
    rng = random.Random(SEED)
    families = [*sorted(TEMPLATES), UNKNOWN]
    labelled = [(t, found_in(t)) for t in pieces_of_documents]
    labelled = [(t, min(f, default=UNKNOWN)) for t, f in labelled if len(f) < 2]
    examples = [(*slots(t), len(t), families.index(f)) for t, f in _examples(rng, per_class) + [x for x in labelled[::2] if x[1] == UNKNOWN]]
    weights, bias = np.zeros((DIMS, len(families))), np.zeros(len(families))
    for epoch in range(EPOCHS):
        rng.shuffle(examples)
        for uni, bi, n, y in examples:
            at, scale = np.concatenate([uni, bi]), max(2 * n - 1, 1) ** -0.5
            z = weights[at].sum(0) * scale + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            rate = RATE / (1 + epoch / 10)
            weights[at] -= rate * (p * scale + DECAY * weights[at])
            bias -= rate * 0.1 * p
    held, loss = _examples(rng, per_class // 4) + labelled[1::2], {}
    for t in (0.5, 0.75, 1.0, 1.5, 2.0, 3.0):
        m = Model(weights, bias, t, families)
        loss[t] = -sum(np.log(m.whole(x)[families.index(f)] + 1e-12) for x, f in held)
    return Model(weights, bias, min(loss, key=loss.get), families)


def in_order(template: list[str], tokens: list[str]) -> list[int]:
    """Places of the tokens in the longest common subsequence of the template and the tokens: the first to end, as late as can be."""
    rows = [[0] * (len(template) + 1)]
    for t in tokens:
        row = [0]
        for j, w in enumerate(template, 1):
            row.append(rows[-1][j - 1] + 1 if t == w else max(rows[-1][j], row[-1]))
        rows.append(row)
    i, j, places = next(i for i, row in enumerate(rows) if row[-1] == rows[-1][-1]), len(template), []
    while i and j:
        if tokens[i - 1] == template[j - 1]:
            i, j = i - 1, j - 1
            places.append(i)
        elif rows[i][j] == rows[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return places[::-1]


def grants(tokens: list[str], model: Model) -> tuple[list[tuple[str, float, int, int]], float]:
    """family, probability against unknown, first and last token of every template that is confirmed; and the least
    probability of unknown among the pieces.
    """
    if not tokens:
        return [], 1.0
    first, end = pieces(len(tokens))
    p = model.probabilities(tokens, first, end)
    at_unknown = model.families.index(UNKNOWN)
    unknown = p[:, at_unknown]
    proposed = p >= PROPOSED * (p + unknown[:, None])
    proposed[:, at_unknown] = False
    if not proposed.any():
        return [], float(unknown.min())
    index = {f: k for k, f in enumerate(model.families)}
    templates = [t for f in np.flatnonzero(proposed.any(0)) for t in BY_FAMILY[model.families[f]]]

    def allowed(t: Template, at: int) -> bool:
        """Whether a piece around the place proposes the family; pieces are in order of their first tokens, and no longer than the longest size."""
        some = slice(*np.searchsorted(first, (at - SLACK - max(SIZES), at + SLACK)))
        return bool((proposed[some, index[t.family]] & (end[some] > at - SLACK)).any())

    met = matches(tokens, templates, allowed)
    out = []
    for family, low, high, _ in settled(met, tokens):
        q = model.whole(tokens[low : high + 1])
        share = float(q[index[family]] / (q[index[family]] + q[at_unknown]))
        if share >= CONFIDENT:
            out.append((family, share, low, high))
    return sorted(out, key=lambda g: (g[2], g[0])), float(unknown.min())


def classify(paragraph: str, model: Model) -> tuple[str, float]:
    """The likeliest of the paragraph's families and its probability; unknown, with the least probability that any piece has of it, if none is confirmed."""
    found, unknown = grants(words(paragraph), model)
    return max(((f, p) for f, p, _, _ in found), key=lambda g: g[1], default=(UNKNOWN, unknown))


def paragraphs(text: str | None) -> list[list[tuple[int, str]]]:
    """Runs of lines that are not blank, each line with its number from 0."""
    out: list[list[tuple[int, str]]] = [[]]
    for i, line in enumerate((text or "").split("\n")):
        if line.strip():
            out[-1].append((i, line))
        elif out[-1]:
            out.append([])
    return [p for p in out if p]


def scan_text(text: str | None, model: Model) -> tuple[int, int, str, str, float]:
    """n_paragraphs, n_licensed, families, spans, unconfirmed."""
    found, licensed, parts, unconfirmed = [], 0, paragraphs(text), 0.0
    for part in parts:
        tokens = [(i, w) for i, line in part for w in words(line)]
        best: dict[tuple[int, int, str], float] = {}
        confirmed, unknown = grants([w for _, w in tokens], model)
        for family, p, low, high in confirmed:
            at = tokens[low][0], tokens[high][0], family
            best[at] = max(p, best.get(at, 0.0))
        licensed += bool(best)
        unconfirmed = unconfirmed if best else max(unconfirmed, 1 - unknown)
        found += sorted((*at, p) for at, p in best.items())
    spans = ",".join(f"{a if a == b else f'{a}-{b}'}:{f}:{p:.3f}" for a, b, f, p in found)
    return len(parts), licensed, ",".join(sorted({x[2] for x in found})), spans, unconfirmed


SCANNED = "n_paragraphs long, n_licensed long, families string, spans string, unconfirmed double"


def scan(docs: DataFrame, id_col: str = "doc_id", model: Model | None = None) -> DataFrame:
    """One row per document: its id, n_paragraphs, n_licensed, families (sorted, comma-joined), spans
    (line:family:probability, or first-last:family:probability of a grant over several lines) and unconfirmed: the
    greatest calibrated probability of any licence in a paragraph without a confirmed one.

    Without a model one is trained on a sample of docs. A null or empty text has no paragraphs; blank lines part
    them; very long texts are scanned whole. Other columns of docs play no part. Row by row, without a shuffle;
    repeated rows each get the same result; an empty table gives no rows.
    """
    docs = docs.select(id_col, "text")
    model = model or train(background(docs, id_col))  # a few hundred kB, which go to the tasks

    @F.pandas_udf(SCANNED)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([scan_text(text, model) for text in texts], columns=[c.split()[0] for c in SCANNED.split(", ")])

    return docs.withColumn("r", found("text")).select(id_col, "r.*")

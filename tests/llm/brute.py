"""Plain, slow versions of what the operators compute."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def hexed(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def near(docs, k=3, percent=85):
    """doc_id -> (n_shingles, component_id, kept)"""
    sets = {}
    for d, t in docs:
        w = SPACE.findall((t or "").translate(LOWER))
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    ids = sorted(sets)
    parent = {d: d for d in ids}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, a in enumerate(ids):
        x = sets[a]
        for b in ids[i + 1 :]:
            y = sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    ra, rb = find(a), find(b)
                    parent[max(ra, rb)] = min(ra, rb)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def repeats(docs, length=200):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256)"""
    data = {d: (t or "").encode() for d, t in docs}
    seen = Counter(b[i : i + length] for b in data.values() for i in range(len(b) - length + 1))
    out = {}
    for d, b in data.items():
        gone = bytearray(len(b))
        upto = 0
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                for j in range(max(i, upto), i + length):
                    gone[j] = 1
                upto = i + length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def later_repeats(docs, length=200):
    """Like repeats, but a string's first copy stays: texts in order of their MD5, rows with one text by id."""
    data = sorted((hashlib.md5((t or "").encode()).digest(), d, (t or "").encode()) for d, t in docs)
    seen, out = set(), {}
    for _, d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if b[i : i + length] in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(b[i : i + length])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest())
    return out


def contamination(docs, items, window=13):
    """doc_id -> (n_words, n_hit, n_items, items_sha256, contaminated)"""
    windows: dict[tuple, set] = {}
    for i, t in items:
        w = ITEM.findall((t or "").translate(LOWER))
        for a in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[a : a + window]), set()).add(str(i))
    sizes = {len(x) for x in windows}
    out = {}
    for d, t in docs:
        w = ITEM.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[a : a + n]))) is not None:
                    hit |= set(range(a, a + n))
                    found |= got
        out[d] = (len(w), len(hit), len(found), hexed(",".join(sorted(found))), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def quality_base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    text = text or ""
    w = SPACE.findall(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def secret_base(text):
    """n_assign, n_access, n_hex, base_sha256"""
    text = text or ""
    found = {
        "assign": [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 6],
        "access": [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20],
        "hex": [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24],
    }
    order = list(found)
    spans = sorted((a, order.index(k), e) for k, s in found.items() for a, e in s)
    return *(len(found[k]) for k in order), hexed(",".join(f"{order[k]}:{a}:{e}" for a, k, e in spans))


def chat(turns):
    """rows (conv_id, turn, role, text) -> conv_id -> (n_turns, turns_sha256, loss_chars, loss_sha256)"""
    by: dict = {}
    for c, t, r, x in turns:
        by.setdefault(c, []).append((t, r or "", x or ""))
    out = {}
    for c, rows in by.items():
        rows.sort()
        loss = "".join(x for _, r, x in rows if r == "assistant")
        out[c] = (len(rows), hexed("".join(f"{r}\n{x}\n" for _, r, x in rows)), len(loss), hexed(loss))
    return out


def url(u):
    """host, path"""
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def url_rule(u, rules):
    """rule, verdict or None"""
    host, path = url(u)
    fits = [(len(h + p), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def targets(sizes: dict, weights=(1, 2, 3), most=3):
    """source -> target, by sharing again and again what is above the limit"""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        share = {s: rest * weight[s] / w for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: most * sizes[s] for s in over}


def licence_families(text, templates, share=0.7, slack=8):
    """Families with a template whose bracketed phrases all stand in a window that has 70 % of its words in order; no
    negation from three words before it up to its last phrase; a match within a longer one, and reserved rights beside a grant, don't count. templates: (family, text).

    Every window of every paragraph is looked at, by regular expressions and a table of common subsequences.
    """
    found = set()
    for part in re.split(r"\n[^\S\n]*(?=\n|$)", (text or "").lower()):
        tokens = re.findall(r"[a-z0-9]+(?:\.[0-9]+)?", part)
        met = []
        for family, template in templates:
            phrases = [" ".join(r"\d+(?:\.\d+)?" if w == "#" else re.escape(w) for w in p.split()) for p in re.findall(r"\[([^]]*)\]", template)]
            words = re.sub(r"[\[\]]", "", template).split()
            if not all(re.search(rf"(?<!\S){p}(?!\S)", " ".join(tokens)) for p in phrases):
                continue
            for a in range(len(tokens)):
                piece = tokens[a : a + len(words) + slack]
                joined = " ".join(piece)
                if not all(re.search(rf"(?<!\S){p}(?!\S)", joined) for p in phrases):
                    continue
                shown = ["#" if "#" in words and w not in words and re.fullmatch(r"\d+(\.\d+)?", w) else w for w in piece]
                if shown[0] not in words:
                    continue
                best = [[0] * (len(words) + 1) for _ in range(len(shown) + 1)]
                for i, x in enumerate(shown):
                    for j, y in enumerate(words):
                        best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
                n = best[-1][-1]
                key = len(joined[: [m.start() for m in re.finditer(rf"(?<!\S){phrases[-1]}(?!\S)", joined)][0]].split())
                denied = {"not", "no", "never", "neither", "nor", "without", "isn", "aren", "wasn", "cannot"} - set(words)
                if n >= share * len(words) and not denied & set(tokens[max(a - 3, 0) : a + key]):
                    end = next(i for i, row in enumerate(best) if row[-1] == n)
                    met.append((family, a, a + end, n))
        left = {(f, tuple(tokens[a:b])) for f, a, b, n in met if not any(c <= a and b <= d and n < m for g, c, d, m in met if g != f)}
        if any(f != "proprietary" for f, _ in left):
            left = {x for x in left if x[0] != "proprietary" or x[1][-3:] != ("all", "rights", "reserved")}
        found |= {f for f, _ in left}
    return ",".join(sorted(found))


def expectation_maximisation(votes, steps, prior, accuracy, pseudo):
    """Posterior of good of each row of votes (1, -1, 0), by EM with made-up votes."""
    n_rules, start, extra = len(votes[0]), prior, pseudo * len(votes)
    right = [accuracy] * n_rules

    def good(row):
        p, q = prior, 1 - prior
        for v, a in zip(row, right):
            if v:
                p, q = p * (a if v > 0 else 1 - a), q * (1 - a if v > 0 else a)
        return p / (p + q)

    for _ in range(steps):
        of = [good(row) for row in votes]
        prior = (sum(of) + extra * start) / (len(votes) + extra)
        cast = [[(q if row[k] > 0 else 1 - q) for row, q in zip(votes, of) if row[k]] for k in range(n_rules)]
        made = [pseudo * max(len(c), 1) for c in cast]
        right = [min(max((sum(c) + m * accuracy) / (len(c) + m), 1e-6), 1 - 1e-6) for c, m in zip(cast, made)]
    return [good(row) for row in votes]

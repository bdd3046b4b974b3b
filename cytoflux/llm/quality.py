"""Quality rules by weak supervision.

Rules vote good or junk on each document, or abstain. Expectation-maximisation over the counts of vote patterns
(at most 3 ** number of rules rows) estimates how often each rule is right, and the posterior probability of good
replaces a conjunction of filters.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoflux.llm.common import cut, space_words

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: One rule for each count, so that no fact votes twice.
#: Rule: the bound beyond which its measure votes junk, and the one up to which it votes good (None: it never does);
#: otherwise it abstains. A measure that must be small has junk > good, one that must be large junk < good.
RULES: dict[str, tuple[float, float | None]] = {
    "letters": (0.88, 0.92),  # letters and digits per character of a word
    "symbols": (0.05, None),  # symbols per character of a word
    "exclaims": (0.05, None),  # exclamation marks per character of a word
    "capitals": (0.5, None),  # capitals per character of a word
    "dup_lines": (0.5, None),  # repeated lines per word line
    "repeats": (0.3, None),  # words in repeated windows per word
    "long_words": (15.0, None),  # characters per word
}
STEPS, PRIOR, ACCURACY = 50, 0.85, 0.8
#: Made-up votes, as a share of each rule's own votes (one at least), and for the classes as a share of the rows, that hold
#: the classes' names at any size of table.
PSEUDO = 0.05


def _windows(words: Column) -> Column:
    """The 3-word windows as (64-bit hash, start), in order of the hash."""
    n = F.size(words)
    at = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(at, lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    return F.sort_array(windows)


def _covered(ordered: Column) -> Column:
    """ordered: windows (hash h, start i) in order of hash. Words under those whose hash has a neighbour that is equal."""
    same = lambda x, j: F.coalesce(F.get(ordered, j)["h"] == x["h"], F.lit(False))
    again = F.filter(ordered, lambda x, j: same(x, j - 1) | same(x, j + 1))
    starts = F.sort_array(F.transform(again, lambda x: x["i"]))
    zero = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    return F.aggregate(starts, zero, lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")), lambda acc: acc["n"].cast("long"))


def _without(text: Column, pattern: str) -> Column:
    """How many characters match the class."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def measure(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, the counts of the base and the counts that the rules look at, of each whole text; null: no words."""
    df = docs.select(id_col, F.coalesce("text", F.lit("")).alias("text"))
    df = df.withColumn("words", space_words(F.col("text")))
    df = df.withColumn("windows", _windows(F.col("words"))).withColumn("joined", F.array_join("words", ""))
    lines = F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    df = df.withColumn("lines", lines)
    return df.select(
        id_col,
        F.size("words").cast("long").alias("n_words"),
        F.length("joined").cast("long").alias("word_chars"),
        _without(F.col("joined"), r"[#*$%&|<>]").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("windows")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        _without(F.col("joined"), "!").cast("long").alias("n_exclaims"),
        _without(F.col("joined"), r"\p{Lu}+").cast("long").alias("n_capitals"),
        _without(F.col("joined"), r"[\p{L}\p{N}]+").cast("long").alias("n_letters"),
    )


def votes(rules: dict[str, tuple[float, float | None]] = RULES) -> dict[str, Column]:
    """Of each rule 1 (good), -1 (junk) or 0 (abstains; also where there is nothing to measure)."""
    per_char = lambda c: F.col(c) / F.nullif(F.col("word_chars"), F.lit(0))
    measures = {
        "symbols": per_char("n_symbols"), "exclaims": per_char("n_exclaims"), "capitals": per_char("n_capitals"), "letters": per_char("n_letters"),
        "dup_lines": F.col("n_dup_lines") / F.nullif(F.col("n_lines"), F.lit(0)), "repeats": F.col("n_repeat_words") / F.nullif(F.col("n_words"), F.lit(0)),
        "long_words": F.col("word_chars") / F.nullif(F.col("n_words"), F.lit(0)),
    }
    out = {}
    for name, (junk, good) in rules.items():
        x = measures[name]
        if good is None:
            out[name] = F.when(x > junk, -1).otherwise(0)
        else:
            is_junk, is_good = (x > junk, x <= good) if junk > good else (x < junk, x >= good)
            out[name] = F.when(is_junk, -1).when(is_good, 1).otherwise(0)
    return out


def fit(patterns: list[tuple[tuple[int, ...], int]], n_rules: int) -> tuple[float, list[float]]:
    """EM for two classes: the share of good, and of each rule how often its votes are right. Abstaining says nothing.

    Every accuracy starts, and is held by `PSEUDO` made-up votes for each vote of the rule, at `ACCURACY`, and the share of good
    at `PRIOR`, so that the classes keep their names.
    """
    prior, accuracies, rows = PRIOR, [ACCURACY] * n_rules, max(sum(n for _, n in patterns), 1)
    cast = [sum(n for p, n in patterns if p[k]) for k in range(n_rules)]
    extra = [PSEUDO * max(c, 1) for c in cast]
    for _ in range(STEPS):
        weights = [(p, n, posterior(p, prior, accuracies)) for p, n in patterns]
        prior = (sum(n * q for _, n, q in weights) + PSEUDO * rows * PRIOR) / (sum(n for _, n, _ in weights) + PSEUDO * rows)
        right = [sum(n * (q if p[k] > 0 else 1 - q) for p, n, q in weights if p[k]) for k in range(n_rules)]
        accuracies = [(r + e * ACCURACY) / (c + e) for r, c, e in zip(right, cast, extra, strict=True)]
    return prior, accuracies


def log_odds(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def posterior(pattern: tuple[int, ...], prior: float, accuracies: list[float]) -> float:
    logit = log_odds(prior) + sum(v * log_odds(a) for v, a in zip(pattern, accuracies, strict=True))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, logit))))


def score_quality(measured: DataFrame, threshold: float = 0.5, rules: dict[str, tuple[float, float | None]] = RULES) -> DataFrame:
    """measured (from `measure`, materialised) plus each vote, quality (posterior of good), base_failed and kept.

    An empty table gives no rows; the model then stays at its start.
    """
    named = {f"vote_{k}": v for k, v in votes(rules).items()}
    voted = measured.withColumns(named)
    counts = voted.groupBy(*named).count().collect()  # 3 ** len(rules) rows at most
    prior, accuracies = fit([(tuple(r[:-1]), r[-1]) for r in counts], len(named))
    logit = F.lit(log_odds(prior))
    for name, accuracy in zip(named, accuracies, strict=True):
        logit = logit + F.col(name) * log_odds(accuracy)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = voted.withColumn("quality", 1 / (1 + F.exp(-logit))).withColumn("base_failed", failed)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def judge_quality(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, its counts, votes, quality, base_failed and kept.

    A null or empty text has no words and fails the base. Repeated rows get the same verdict, each its own row; very
    long texts are measured whole; other columns of docs play no part; an empty table gives no rows.
    """
    return score_quality(cut(measure(docs)), threshold)


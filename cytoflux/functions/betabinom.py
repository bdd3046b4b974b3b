"""Beta-binomial tails and Fisher's exact test as Column expressions; the beta-binomial fit from counts."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Fixed coefficients of Stirling's series for the logarithm of the gamma function.
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)


def log_gamma(x: Column) -> Column:
    """ln(gamma(x)) of x > 0: Stirling's series at x + 8, and the eight steps down from there."""
    y = x + 8
    steps = reduce(lambda p, i: p * (x + i), range(1, 8), x)
    series = reduce(lambda s, c: s / (y * y) + c, reversed(STIRLING[:-1]), F.lit(STIRLING[-1])) / y
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(steps)


def _up_to(m: Column, n: Column, alpha: float, beta: float) -> Column:
    """P(X <= m) of n trials: the probability of 0 in closed form, each following one a multiple of the one before."""
    zero = F.exp(log_gamma(n + beta) - log_gamma(n + (alpha + beta)) + (math.lgamma(alpha + beta) - math.lgamma(beta)))
    step = lambda a, i: F.struct((a["p"] * (n - i) * (i + alpha) / ((i + 1.0) * (n - i - 1 + beta))).alias("p"), (a["s"] + a["p"]).alias("s"))
    return F.aggregate(F.sequence(F.lit(0), m), F.struct(zero.alias("p"), F.lit(0.0).alias("s")), step, lambda a: a["s"])


def tail(k: Column, n: Column, alpha: float, beta: float) -> Column:
    """P(X >= k) of n trials, rounded to 4 places; 1 for k = 0 or n = 0, 0 for k > n. The side with fewer terms is summed."""
    k, n = k.cast("int"), n.cast("int")
    left, right = k - 1, n - k
    value = F.when(left <= right, 1 - _up_to(F.greatest(left, F.lit(0)), n.cast("double"), alpha, beta)).otherwise(_up_to(F.greatest(right, F.lit(0)), n.cast("double"), beta, alpha))
    return F.when((n <= 0) | (k <= 0), 1.0).when(k > n, 0.0).otherwise(F.round(value, 4))


def fisher(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Two-sided exact p of the table (a b / c d), rounded to 4 places: tables no likelier than the given one.

    Each table's probability is a multiple of the one before; logarithms relative to the first, so that nothing
    overflows. Two passes over the tables: the given one's and the greatest logarithm, then the sums.
    """
    a, b, c, d = (x.cast("int") for x in (a, b, c, d))
    top, bottom, col = a + b, c + d, a + c
    low, high = F.greatest(F.lit(0), col - bottom), F.least(top, col)
    tables = F.sequence(low, high)
    following = lambda w, x: w + F.log((top - x).cast("double") * (col - x) / ((x + 1.0) * (bottom - col + x + 1)))
    nothing = F.lit(0.0)
    first = F.aggregate(tables, F.struct(nothing.alias("w"), nothing.alias("own"), nothing.alias("most")), lambda s, x: F.struct(F.when(x < high, following(s["w"], x)).otherwise(s["w"]).alias("w"), F.when(x == a, s["w"]).otherwise(s["own"]).alias("own"), F.greatest(s["most"], s["w"]).alias("most")), lambda s: F.struct(s["own"].alias("own"), s["most"].alias("most")))

    def summed(bounds: Column) -> Column:
        weight = lambda s: F.exp(s["w"] - bounds["most"])
        step = lambda s, x: F.struct(F.when(x < high, following(s["w"], x)).otherwise(s["w"]).alias("w"), (s["all"] + weight(s)).alias("all"), (s["rare"] + F.when(s["w"] <= bounds["own"] + 1e-7, weight(s)).otherwise(0.0)).alias("rare"))
        return F.aggregate(tables, F.struct(nothing.alias("w"), nothing.alias("all"), nothing.alias("rare")), step, lambda s: s["rare"] / s["all"])

    return F.round(F.least(F.lit(1.0), F.get(F.transform(F.array(first), summed), 0)), 4)


def _digamma(x: float) -> float:
    out = 0.0
    while x < 10:
        out -= 1 / x
        x += 1
    f = 1 / (x * x)
    return out + math.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f / 132))))


def fit(successes: list[tuple[int, int]], failures: list[tuple[int, int]], trials: list[tuple[int, int]], steps: int = 2000) -> tuple[float, float]:
    """Maximum-likelihood alpha and beta from three histograms (value, how often), by Minka's fixed point.

    The sums of the fixed point are separate in successes, failures and trials, so that the histograms say all.
    """
    total, hit = sum(n * m for n, m in trials), sum(x * m for x, m in successes)
    mean = max(hit / total, 1e-6) if total else 0.01
    a, b = mean * 20, (1 - mean) * 20
    rise = lambda pairs, s: sum(m * (_digamma(x + s) - _digamma(s)) for x, m in pairs if x)
    for _ in range(steps if total else 0):
        down = rise(trials, a + b)
        new_a, new_b = a * rise(successes, a) / down, b * rise(failures, b) / down
        done = abs(new_a - a) < 1e-9 * a and abs(new_b - b) < 1e-9 * b
        a, b = new_a, new_b
        if done or not a or not b:
            break
    return a, b


def fit_frame(training: DataFrame, successes: str, trials: str) -> tuple[float, float]:
    """fit of two count columns. The histograms, of as many rows as there are different depths, reach the driver."""
    x, n = F.col(successes), F.col(trials)
    named = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.cast("long").alias("value")) for k, v in enumerate((x, n - x, n))]))
    rows = training.where(n > 0).select(named.alias("of")).groupBy("of.kind", "of.value").count().collect()
    return fit(*[sorted((r[1], r[2]) for r in rows if r[0] == k) for k in range(3)])

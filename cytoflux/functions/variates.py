"""Random variates as column expressions: hashes of a seed and of the parts that name a draw, so that a lost task draws again alike."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Proposals of a gamma variate. Each is accepted with a probability of over 0.95, so that all fail in one of 10 ** 13 draws.
ATTEMPTS = 10


def uniform(seed: int, *parts: Column | str) -> Column:
    """A number in (0, 1) that the parts fix."""
    return (F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(1 << 40)) + 0.5) / float(1 << 40)


def normal(seed: int, *parts: Column | str) -> Column:
    """A standard normal variate, by the polar angle of two uniform ones."""
    return F.sqrt(-2 * F.log(uniform(seed, F.lit("radius"), *parts))) * F.cos(2 * math.pi * uniform(seed, F.lit("angle"), *parts))


def log_gamma(shape: Column, seed: int, *parts: Column | str) -> Column:
    """The logarithm of a gamma variate of that shape (above 0) and scale 1, by Marsaglia and Tsang's squeeze of a cubed normal.

    A shape below 1 is raised by 1, and the variate is scaled by a power of a uniform one; the logarithm keeps tiny ones apart from 0.
    """
    d = F.when(shape < 1, shape + 1).otherwise(shape) - 1 / 3

    def attempt(i: Column) -> Column:
        x = normal(seed, F.lit("proposal"), i, *parts)
        v = F.pow(1 + x / F.sqrt(9 * d), F.lit(3.0))
        good = (v > 0) & (F.log(uniform(seed, F.lit("acceptance"), i, *parts)) < 0.5 * x * x + d - d * v + d * F.log(v))
        return F.when(good, F.log(d * v))

    # The first proposals by themselves, as later ones are hardly ever looked at.
    later = F.get(F.filter(F.transform(F.sequence(F.lit(2), F.lit(ATTEMPTS - 1)), attempt), lambda x: x.isNotNull()), F.lit(0))
    boost = F.when(shape < 1, F.log(uniform(seed, F.lit("boost"), *parts)) / shape).otherwise(0.0)
    return F.coalesce(attempt(F.lit(0)), attempt(F.lit(1)), later, F.log(d)) + boost


def beta(a: Column, b: Column, seed: int, *parts: Column | str) -> Column:
    """A beta variate, from two gamma ones."""
    return 1 / (1 + F.exp(log_gamma(b, seed, F.lit("b"), *parts) - log_gamma(a, seed, F.lit("a"), *parts)))


def gumbel(seed: int, *parts: Column | str) -> Column:
    """Added to the logarithms of weights, the greatest sum is a draw by weight."""
    return -F.log(-F.log(uniform(seed, *parts)))

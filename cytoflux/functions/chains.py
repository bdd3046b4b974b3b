"""Thresholds of chain diagnostics, and trees as edges."""

from __future__ import annotations

import math
import re
from statistics import NormalDist


def psrf_cutoff(epsilon: float, alpha: float = 0.05) -> float:
    """The scale reduction factor at which the effective sample size suffices for relative precision epsilon."""
    chi2 = NormalDist().inv_cdf(1 - alpha / 2) ** 2  # quantile of one degree of freedom
    least = 4 * math.pi * chi2 / (math.gamma(0.5) ** 2 * epsilon**2)
    return math.sqrt(1 + 1 / least)


def tree_edges(newick: str) -> list[tuple[str, str, float]]:
    """(parent, child, branch length) of a Newick text; inner nodes without a name are n0, n1, ... as they close."""
    edges, waiting, unnamed = [], [[]], 0
    for token in re.finditer(r"\(|(\))?([^(),:;]*)(?::([-+.\deE]+))?,?", newick.strip()):
        if token[0] == "(":
            waiting.append([])
        elif token[0]:
            name, children = token[2].strip(), []
            if token[1]:
                children = waiting.pop()
                if not name:
                    name, unnamed = f"n{unnamed}", unnamed + 1
            edges += [(name, child, length) for child, length in children]
            if name:
                waiting[-1].append((name, float(token[3] or 0)))
    return edges

"""Reproducible pseudo-random columns.

Every draw is a pure function of (key, salt): the first 52 bits of ``md5(key:salt)``. Unlike ``rand(seed)`` or
``randomSplit`` the value of a row does not depend on partitioning, row order or retries, so a job that recomputes
a lost partition, or reads the table with another file layout, sees the same draws. All of it stays in codegen.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = float(16**13)
BETA_STEPS = 1000


def uniform(key: str, salt: str) -> Column:
    """A double in [0, 1)."""
    return F.expr(_uniform(key, salt))


def normal(key: str, salt: str, mean: float = 0.0, sigma: float = 1.0) -> Column:
    """Box-Muller over two uniform draws."""
    return F.expr(_normal(key, salt, mean, sigma))


def lognormal(key: str, salt: str, mean: float, sigma: float) -> Column:
    return F.expr(f"exp({_normal(key, salt, mean, sigma)})")


def int_range(key: str, salt: str, low: int, high: int) -> Column:
    """An integer in [low, high)."""
    return F.expr(f"cast({low} + floor({_uniform(key, salt)} * {_double(high - low)}) as int)")


def bernoulli(key: str, salt: str, p: float) -> Column:
    return F.expr(f"cast({_uniform(key, salt)} < {_double(p)} as int)")


def poisson(key: str, salt: str, lam: float) -> Column:
    """Inverse CDF: how many cumulative probabilities lie below the draw."""
    below = f"size(filter({_array(poisson_cdf(lam))}, c -> c < u))"
    # bound once, outside the inner lambda: the digest is not taken again for every step
    return F.expr(f"get(transform(array({_uniform(key, salt)}), u -> {below}), 0)")


def beta(key: str, salt: str, a: float, b: float) -> Column:
    """Linear interpolation in a table of beta quantiles."""
    table, position = _array(beta_quantiles(a, b)), f"({_uniform(key, salt)} * {_double(BETA_STEPS)})"
    slot = f"cast(floor({position}) as int)"
    low, high = f"get({table}, {slot})", f"get({table}, {slot} + 1)"
    return F.expr(f"{low} + ({high} - {low}) * ({position} - {slot})")


def choice(key: str, salt: str, values: list[str]) -> Column:
    """One of ``values``, all equally likely."""
    return F.get(F.lit(list(values)), int_range(key, salt, 0, len(values)))


def weighted_choice(key: str, salt: str, weights: dict[str, float]) -> Column:
    """One of the given values, with the given weights."""
    u = uniform(key, salt)
    *steps, (last, _) = cumulative_weights(weights)
    options = [F.when(u < F.lit(edge), F.lit(value)) for value, edge in steps]
    return F.coalesce(*options, F.lit(last))


# The expressions are put together as SQL text: one call to the JVM per draw instead of one per function.


def _uniform(key: str, salt: str) -> str:
    digest = f"md5(cast(concat(cast(`{key}` as string), ':{salt}') as binary))"
    return f"(cast(conv(substring({digest}, 1, 13), 16, 10) as double) / {_double(UNIT)})"


def _normal(key: str, salt: str, mean: float, sigma: float) -> str:
    radius = f"sqrt(-2D * ln(greatest({_uniform(key, salt + '1')}, 1e-300D)))"
    z = f"{radius} * cos({_double(2.0 * math.pi)} * {_uniform(key, salt + '2')})"
    return f"({_double(mean)} + {_double(sigma)} * ({z}))"


def _double(value: float) -> str:
    return f"{float(value)!r}D"


def _array(values: tuple[float, ...]) -> str:
    return "array(" + ", ".join(map(_double, values)) + ")"


def cumulative_weights(weights: dict[str, float]) -> list[tuple[str, float]]:
    """(value, upper edge) pairs in the given order."""
    edges = np.cumsum(list(weights.values())) / sum(weights.values())
    return [(value, float(edge)) for value, edge in zip(weights, edges)]


@lru_cache(maxsize=None)
def poisson_cdf(lam: float) -> tuple[float, ...]:
    """Cumulative probabilities up to the point where doubles no longer grow."""
    term = total = math.exp(-lam)
    steps, k = [total], 0
    while total < 1.0 and k < lam + 40 * math.sqrt(lam + 1) + 40:
        k += 1
        term *= lam / k
        if total + term == total and k > lam:
            break
        total += term
        steps.append(total)
    return tuple(steps)


@lru_cache(maxsize=None)
def beta_quantiles(a: float, b: float) -> tuple[float, ...]:
    """Quantiles at 0, 1/1000, .. 1 by integrating the density on a fine midpoint grid."""
    cells = 200_000
    x = (np.arange(cells) + 0.5) / cells
    mass = np.concatenate([[0.0], np.cumsum(x ** (a - 1) * (1 - x) ** (b - 1))])
    targets = np.arange(BETA_STEPS + 1) / BETA_STEPS
    edges = np.interp(targets, mass / mass[-1], np.arange(cells + 1) / cells)
    return tuple(float(round(v, 12)) for v in edges)

"""Seeded draws computed from a row id.

A draw is a pure function of (id, seed): it survives task retries, does not
depend on partitioning, and plain SQL can reproduce it.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MODULUS = 2_147_483_647


def constants(seed: int) -> tuple[int, int]:
    """Multiplier and offset of a seed, both below the modulus."""
    return 1 + (48_271 * (seed + 1)) % (MODULUS - 1), (69_621 * (seed + 1) + 12_345) % MODULUS


def start(row_id: Column) -> Column:
    """The id in [0, MODULUS), where every draw begins."""
    return F.pmod(row_id.cast("bigint"), F.lit(MODULUS).cast("bigint"))


def rounds(seed: int) -> list[Callable[[Column, Column], Column]]:
    """The three rounds of a draw, as functions of the value so far and the start. Products stay within 64 bits."""
    multiplier, offset = (F.lit(c).cast("bigint") for c in constants(seed))
    modulus = F.lit(MODULUS).cast("bigint")
    return [
        lambda value, base: F.pmod(base * multiplier + offset, modulus),
        lambda value, base: F.pmod(value * value + base, modulus),
        lambda value, base: F.pmod(value * value + offset, modulus),
    ]


def draw(row_id: Column, seed: int) -> Column:
    """A number in [0, MODULUS), as one expression. It holds the id several times over: for whole tables see
    :func:`riskmart.operators.defects.with_draws`."""
    base = start(row_id)
    value = base
    for step in rounds(seed):
        value = step(value, base)
    return value


def threshold(rate: float) -> int:
    return math.floor(rate * MODULUS)


def chosen(drawn: Column, rate: float) -> Column:
    """True for about ``rate`` of all draws."""
    return drawn < F.lit(threshold(rate))


def selected(row_id: Column, seed: int, rate: float) -> Column:
    """True for about ``rate`` of all ids."""
    return chosen(draw(row_id, seed), rate)


def copy_thresholds(rate: float) -> list[int]:
    """Thresholds for drawing with replacement at ``rate`` draws per row.

    The number of times a row is drawn follows a Poisson law; a row is drawn at
    least k times when its draw lies below the k-th threshold. The list ends
    where no draw can reach the next threshold.
    """
    thresholds: list[int] = []
    term, k = math.exp(-rate), 0
    below = term
    while (limit := threshold(1.0 - below)) > 0:
        thresholds.append(limit)
        k += 1
        term *= rate / k
        below += term
    return thresholds

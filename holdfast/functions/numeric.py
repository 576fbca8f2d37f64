"""Numeric expressions with the null, tie and rounding rules fixed in one place."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(terms: list[Column]) -> Column:
    """Left-to-right sum; the order is part of the result for doubles."""
    return reduce(lambda a, b: a + b, terms)


def round_even(value: Column, digits: int) -> Column:
    """Scale, round half to even, unscale: the rule of numpy's ``round``."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def clip(value: Column, low: float, high: float) -> Column:
    """Bound ``value``; null stays null, where ``greatest``/``least`` would skip it."""
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def index(value: Column, low: float = 0.0, high: float = 100.0) -> Column:
    """Bounded index at two decimals."""
    return round_even(clip(value.cast("double"), float(low), float(high)), 2)


def flag(condition: Column) -> Column:
    """1 or 0; a condition that is null counts as not met."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def cents(amount: Column) -> Column:
    """Exact integer hundredths, so sums do not depend on the order of addition."""
    return F.rint(amount * 100.0).cast("long")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division giving null on a zero denominator."""
    return F.when(denominator != 0, numerator / denominator)


def sigmoid(value: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-value))


def keyed_digest(seed: int, key: Column, purpose: str) -> Column:
    """Hex text that orders keys at random, but the same way on any partitioning."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"), F.lit(purpose)))


def keyed_uniform(seed: int, key: Column, purpose: str) -> Column:
    """A number in [0, 1) that depends on seed, key and purpose only."""
    head = F.substring(keyed_digest(seed, key, purpose), 1, 13)
    return F.conv(head, 16, 10).cast("long") / F.lit(float(2**52))

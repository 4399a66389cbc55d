"""Repeatable randomness: draws depend only on a seed and row ids.

``rand()`` changes with partitioning and with every retried task, so choices
are taken from a digest of the ids instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(seed: str, *parts: Column) -> Column:
    """Uniform integer in [0, 2**32) from ``seed`` and the given columns."""
    text = F.concat_ws("|", F.lit(seed), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def chance(seed: str, probability: float, *parts: Column) -> Column:
    """True with the given probability."""
    return draw(seed, *parts) < F.lit(int(probability * 2**32))

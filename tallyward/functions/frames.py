"""Small DataFrame combinators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """``UNION ALL`` by column name (a narrow operation: no shuffle)."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_all needs at least one DataFrame")
    return reduce(lambda a, b: a.unionByName(b), frames)

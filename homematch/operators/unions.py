"""Unions of sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def stacked(*frames: DataFrame) -> DataFrame:
    """All rows of frames with different columns; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_union(column: str, *frames: DataFrame) -> DataFrame:
    """Distinct values of one column over all frames."""
    return stacked(*[f.select(column) for f in frames]).distinct()

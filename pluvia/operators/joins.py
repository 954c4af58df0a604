"""Dimension joins and the coverage gap.

No join carries a broadcast hint: the planner broadcasts a side whose estimated bytes
are under its threshold, AQE does so from measured sizes and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def attach_dimension(fact: DataFrame, dim: DataFrame, on: Column | str | list,
                     how: str = "inner") -> DataFrame:
    """Add a dimension's columns to facts."""
    return fact.join(dim, on, how)


def coverage_gap(requested: DataFrame, responses: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Requested keys with no response (``NOT EXISTS``).

    The responses are reduced to their distinct keys first (combined map-side), so a
    responder with most of the rows reaches the anti join as one row a task.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return requested.join(responses.select(*keys).distinct(), keys, "left_anti")

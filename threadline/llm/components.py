"""Connected components of a written edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from threadline.operators import components as shared

from .common import stored


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges (a, b); a component is named by its smallest node."""
    return shared.components(edges, lambda df: stored(df, "stars"), rounds)

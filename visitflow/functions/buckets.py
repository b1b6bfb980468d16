"""Histogram bucket labels as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels and edges of the session histogram.  The labels are the keys of the
# reference's result map and must be spelled exactly so (note the capital S in "0s-30S").
DURATION_LABELS = ("0s-30S", "30s-60s", "1m-3m", "3m-10m", "10m")
DURATION_EDGES_S = (30, 60, 180, 600)
PAGE_LABELS = ("0-4", "4-7", "7-10")
PAGE_EDGES = (4, 7)
PAGE_TOP = 10
OTHER_LABEL = "other"
SESSION_COUNT_LABEL = "sessionCount"


def duration_bucket(
    seconds: Column,
    edges: Sequence[int] = DURATION_EDGES_S,
    labels: Sequence[str] = DURATION_LABELS,
) -> Column:
    """``labels[i]`` for ``edges[i-1] <= seconds < edges[i]``; below the first edge (negatives
    too) the first label, from the last edge on the last label."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need exactly one more label than edges")
    expr = F.when(seconds < edges[0], F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:-1]):
        expr = expr.when(seconds < edge, F.lit(label))
    return expr.when(seconds.isNotNull(), F.lit(labels[-1]))


def page_bucket(
    pages: Column,
    edges: Sequence[int] = PAGE_EDGES,
    top: int = PAGE_TOP,
    labels: Sequence[str] = PAGE_LABELS,
    other: str = OTHER_LABEL,
) -> Column:
    """``labels[i]`` for ``edges[i-1] <= pages < edges[i]``, the last label up to ``top``
    inclusive, and ``other`` above it (the reference failed there)."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need exactly one more label than edges")
    expr = F.when(pages < edges[0], F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:-1]):
        expr = expr.when(pages < edge, F.lit(label))
    return expr.when(pages <= top, F.lit(labels[-1])).when(pages.isNotNull(), F.lit(other))

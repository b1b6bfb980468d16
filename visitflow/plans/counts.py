"""Counts that come with the pass that writes a table, by ``DataFrame.observe``: no job of their own.

Spark adds up the metrics of a task once, those of the attempt that succeeded, and hands them over with
the first action on the frame that ends well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ROWS = "rows"


class TableCounts:
    """Named counts of frames.  ``watch`` before the action, ``get`` after it."""

    def __init__(self):
        self._watched: dict[str, Observation] = {}

    def watch(self, name: str, frame: DataFrame, **metrics: Column) -> DataFrame:
        """``frame``, whose next action also counts its rows and the aggregates ``metrics``."""
        self._watched[name] = Observation()
        return frame.observe(self._watched[name], F.count(F.lit(1)).alias(ROWS), *(m.alias(k) for k, m in metrics.items()))

    def get(self, name: str) -> dict[str, int]:
        """The counts of a watched frame; waits for its action."""
        return dict(self._watched[name].get)

    def all(self) -> dict[str, dict[str, int]]:
        """All watched frames.  Each must have had its action."""
        return {name: self.get(name) for name in self._watched}

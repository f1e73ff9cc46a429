"""Figures taken of a table while something else reads it."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Watch:
    """Aggregates observed while ``df`` is written.

    Place it where only narrow operators follow, in the last stage of the
    write: a result task counts once, however often it is tried, while tasks
    before a shuffle may run, and count, again when an executor is lost.
    """

    def __init__(self, df: DataFrame, metrics: list[Column]):
        self._observation = Observation()
        self.df = df.observe(self._observation, *metrics)

    @classmethod
    def rows(cls, df: DataFrame) -> Watch:
        return cls(df, [F.count(F.lit(1)).alias("row_count")])

    @property
    def values(self) -> dict[str, Any]:
        """The figures; waits for the write."""
        return self._observation.get

    @property
    def row_count(self) -> int:
        return self.values.get("row_count", 0)

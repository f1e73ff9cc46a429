"""Metrics as partial states that are stored by hour and merged into longer grains.

Sums, counts, extremes, means and distinct counts are kept, per hour and group, as
values that merge: a mean as sum and count, a distinct count as the set of values.
A day, week or month is the merge of its hours, so a day that changes costs its
own rows and the states of the periods around it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.scalar import truncate_to_grain

CALL = re.compile(r"\s*(sum|count|min|max|avg|mean)\s*\(\s*(distinct\s+)?(.*)\)\s*", re.IGNORECASE | re.DOTALL)
PERIOD = "agg_date"


@dataclass(frozen=True)
class Metric:
    """One metric: its kind, and what it is taken of."""

    name: str
    kind: str
    value: str

    @classmethod
    def parse(cls, name: str, expression: str) -> Metric:
        """From a single SQL aggregate; others cannot be merged and are an error."""
        found = CALL.fullmatch(expression)
        if found is None or not _balanced(found[3]):
            raise ValueError(f"{expression!r} has no state that can be merged")
        kind, distinct, value = found[1].lower().replace("mean", "avg"), found[2], found[3].strip()
        if distinct:
            if kind != "count":
                raise ValueError(f"{expression!r} has no state that can be merged")
            kind = "distinct"
        return cls(name, kind, "1" if value == "*" else value)

    def column(self, part: str) -> str:
        return f"{self.name}__{part}"

    def first(self) -> dict[str, Column]:
        """Its states over rows."""
        value = F.expr(self.value)
        states = {
            "sum": {"sum": F.sum},
            "count": {"n": F.count},
            "avg": {"sum": F.sum, "n": F.count},
            "min": {"min": F.min},
            "max": {"max": F.max},
            "distinct": {"set": F.collect_set},
        }[self.kind]
        return {self.column(part): take(value) for part, take in states.items()}

    def merged(self) -> dict[str, Column]:
        """The same states over states."""

        def union(sets: Column) -> Column:
            return F.array_distinct(F.flatten(F.collect_list(sets)))

        merge = {"sum": F.sum, "n": F.sum, "min": F.min, "max": F.max, "set": union}
        return {c: merge[c.rsplit("__", 1)[1]](F.col(c)) for c in self.first()}

    def result(self) -> Column:
        part = {p: F.col(self.column(p)) for p in ("sum", "n", "min", "max", "set")}
        return {
            "sum": part["sum"],
            "count": part["n"],
            "avg": F.try_divide(part["sum"], part["n"]),
            "min": part["min"],
            "max": part["max"],
            "distinct": F.size(part["set"]).cast("long"),
        }[self.kind].alias(self.name)


def _balanced(text: str) -> bool:
    """Whether the closing bracket that was taken off closed the first one."""
    depth = 0
    for sign in text:
        depth += (sign == "(") - (sign == ")")
        if depth < 0:
            return False
    return depth == 0


def parse_metrics(metrics: Mapping[str, str]) -> list[Metric]:
    return [Metric.parse(name, expression) for name, expression in metrics.items()]


def _aliased(columns: Mapping[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


def first_states(
    df: DataFrame,
    metrics: Sequence[Metric],
    dimensions: Sequence[str],
    time_column: str,
    grain: str = "hourly",
) -> DataFrame:
    """States per group and period, ``agg_date``; rows without a time have a null period."""
    period = truncate_to_grain(F.col(time_column), grain, dict(df.dtypes)[time_column])
    states = {n: c for m in metrics for n, c in m.first().items()}
    return df.withColumn(PERIOD, period).groupBy(*dimensions, PERIOD).agg(*_aliased(states))


def merge_states(
    states: DataFrame, metrics: Sequence[Metric], dimensions: Sequence[str], grain: str
) -> DataFrame:
    """States of a longer grain from those of a shorter one that it is made of."""
    period = truncate_to_grain(F.col(PERIOD), grain, dict(states.dtypes)[PERIOD])
    merged = {n: c for m in metrics for n, c in m.merged().items()}
    return states.withColumn(PERIOD, period).groupBy(*dimensions, PERIOD).agg(*_aliased(merged))


def read_metrics(states: DataFrame, metrics: Sequence[Metric], dimensions: Sequence[str]) -> DataFrame:
    """What the states say: dimensions, ``agg_date`` and the metrics by name."""
    return states.select(*dimensions, PERIOD, *[m.result() for m in metrics])

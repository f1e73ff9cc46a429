"""Gold reports of several grains, kept up to date from stored states.

``refresh_reports`` takes the days that have changed. It aggregates the rows of
those days alone, replaces their states, and rewrites the periods around them
from states: the rows of a month are not read again because one day of it came in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.scalar import GRAIN_UNITS
from tierflow.operators.columns import add_custom_columns
from tierflow.operators.states import PERIOD, Metric, first_states, merge_states, parse_metrics, read_metrics
from tierflow.sinks.tables import clear_partition, rebalance, replace_partitions, save_table, table_exists
from tierflow.staging import staged

STATE_DAY, REPORT_DAY = "state_day", "period_start"


@dataclass(frozen=True)
class Reports:
    """What is reported of a table: metrics by dimensions, in one table per grain."""

    source: str
    target: str
    time_column: str
    dimensions: tuple[str, ...]
    metrics: Mapping[str, str]
    grains: tuple[str, ...] = tuple(GRAIN_UNITS)
    custom_dimensions: Mapping[str, str] | None = None

    @classmethod
    def of(cls, spec: Mapping[str, Any], grains: Sequence[str] = tuple(GRAIN_UNITS)) -> Reports:
        """From the specification of a gold layer; ``agg_date`` is implied."""
        source, destination, transform = spec["source"], spec["destination"], spec["transform"]
        database = source.get("database", "default")
        return cls(
            f"{database}.{source['table']}",
            f"{destination.get('database', database)}.{destination['table']}",
            transform.get("time_column", "load_timestamp"),
            tuple(d for d in transform["dimensions"] if d != PERIOD),
            transform["metrics"],
            tuple(grains),
            transform.get("custom_dimensions"),
        )

    @property
    def states(self) -> str:
        return f"{self.target}__states"

    def table(self, grain: str) -> str:
        return f"{self.target}_{grain}"


def first_day(day: date, grain: str) -> date:
    """The first day of the period of a grain that a day lies in."""
    if grain == "weekly":
        return day - timedelta(days=day.weekday())
    return day.replace(day=1) if grain == "monthly" else day


def last_day(first: date, grain: str) -> date:
    """The last day of the period that begins on ``first``."""
    if grain == "weekly":
        return first + timedelta(days=6)
    if grain == "monthly":
        return (first + timedelta(days=31)).replace(day=1) - timedelta(days=1)
    return first


def changed_days(rows: DataFrame, time_column: str) -> list[date | None]:
    """The days that rows lie in; None for rows without a time."""
    return [r[0] for r in rows.select(F.to_date(time_column)).distinct().collect()]


def _on_days(column: Column, days: Sequence[date | None]) -> Column:
    some = [d for d in days if d is not None]
    on = column.isin(some) if some else F.lit(False)
    return on | column.isNull() if None in days else on


def _of_days(df: DataFrame, time_column: str, days: Sequence[date | None]) -> DataFrame:
    """Rows of some days; the plain range is the part that reaches the files."""
    some = sorted(d for d in days if d is not None)
    time, kind = F.col(time_column), dict(df.dtypes)[time_column]
    if some and None not in days:
        first, after = (F.lit(str(d)).cast(kind) for d in (some[0], some[-1] + timedelta(days=1)))
        df = df.where((time >= first) & (time < after))
    return df.where(_on_days(F.to_date(time), days))


def _replace(spark: SparkSession, rows: DataFrame, table: str, partition: str, values: Sequence[date | None]) -> None:
    """Make ``rows`` the content of the partitions ``values``, also of those without any."""
    if not table_exists(spark, table):
        save_table(rebalance(rows, [partition]), table, partitions=[partition])
        return
    with staged(rows, "periods") as stored:
        filled = {r[0] for r in stored.select(partition).distinct().collect()}
        held = spark.table(table).where(_on_days(F.col(partition), values))
        stale = {r[0] for r in held.select(partition).distinct().collect()} - filled
        replace_partitions(rebalance(stored, [partition]), table)
        for value in stale:
            clear_partition(spark, table, {partition: value})


def refresh_reports(
    spark: SparkSession, reports: Reports, days: Sequence[date | None] | None = None
) -> None:
    """Bring the tables of all grains up to date with the rows of ``days``.

    Days may be given again; their states are replaced, not added to. ``None``
    among them stands for rows without a time. Without ``days`` all are taken.
    Metrics are single sums, counts, distinct counts, extremes or means.
    """
    metrics = parse_metrics(reports.metrics)
    source = add_custom_columns(spark.table(reports.source), reports.custom_dimensions or {})
    if days is None:
        days = changed_days(source, reports.time_column)
    elif not days:
        return
    dimensions = list(reports.dimensions)
    rows = _of_days(source, reports.time_column, days)
    fresh = first_states(rows, metrics, dimensions, reports.time_column)
    _replace(spark, fresh.withColumn(STATE_DAY, F.to_date(PERIOD)), reports.states, STATE_DAY, days)
    states = spark.table(reports.states)
    for grain in reports.grains:
        _replace(spark, _report(states, reports, metrics, grain, days), reports.table(grain), REPORT_DAY, _periods(days, grain))


def _periods(days: Sequence[date | None], grain: str) -> list[date | None]:
    return sorted({d and first_day(d, grain) for d in days}, key=str)


def _report(
    states: DataFrame, reports: Reports, metrics: Sequence[Metric], grain: str, days: Sequence[date | None]
) -> DataFrame:
    """The periods of a grain that some days lie in, from the states of their days."""
    condition = F.lit(False)
    for first in _periods(days, grain):
        day = F.col(STATE_DAY)
        condition = condition | (day.isNull() if first is None else day.between(first, last_day(first, grain)))
    dimensions = list(reports.dimensions)
    merged = merge_states(states.where(condition).drop(STATE_DAY), metrics, dimensions, grain)
    return read_metrics(merged, metrics, dimensions).withColumn(REPORT_DAY, F.to_date(PERIOD))

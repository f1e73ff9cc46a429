"""Grains, metrics and report metadata."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions.scalar import GRAIN_UNITS, truncate_to_grain

log = logging.getLogger(__name__)


def add_grain(
    df: DataFrame, grain: str = "daily", time_column: str = "load_timestamp"
) -> DataFrame:
    """Add ``agg_date``, the start of the grain each row falls in.

    An unknown grain, or a table without the time column, adds nothing.
    """
    types = dict(df.dtypes)
    if grain not in GRAIN_UNITS or time_column not in types:
        log.warning("no agg_date: grain %s, time column %s", grain, time_column)
        return df
    return df.withColumn(
        "agg_date", truncate_to_grain(F.col(time_column), grain, types[time_column])
    )


def calculate_metrics(
    df: DataFrame, metrics: Mapping[str, str], dimensions: Sequence[str]
) -> DataFrame:
    """Aggregate ``{name: SQL aggregate}`` by the dimensions.

    Any aggregate Spark knows may be used. Without dimensions, or without
    metrics, the table passes through.
    """
    if not metrics:
        return df
    if not dimensions:
        log.warning("no dimensions given, metrics skipped")
        return df
    missing = [d for d in dimensions if d not in df.columns]
    if missing:
        raise ValueError(f"dimensions {missing} are not columns of the table")
    return df.groupBy(*dimensions).agg(
        *[F.expr(expression).alias(name) for name, expression in metrics.items()]
    )


def add_report_metadata(df: DataFrame) -> DataFrame:
    """Add when the report was made, and the same as its version."""
    now = F.current_timestamp()
    return df.withColumns(
        {"report_generated_at": now, "report_version": now.cast("string")}
    )

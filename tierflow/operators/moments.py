"""Hour-of-day profiles from stored moments, a day at a time.

A count, a mean and a sum of squared deviations of each measure, per entity, hour
and day, are all that a profile needs, and they merge without loss. So a profile
of any window of days is the merge of the moments of its days, and a window that
moves on by a day reads the readings of that day alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.timeseries import TURBINES, Instant, Series
from tierflow.sinks.tables import clear_partition, rebalance, replace_partitions, save_table, table_exists
from tierflow.staging import staged

DAY = "date"


def daily_moments(placed: DataFrame, series: Series = TURBINES) -> DataFrame:
    """Moments per entity, hour and day of readings on the grid, as ``on_grid`` gives them.

    ``{measure}_n`` counts values that are not null, ``{measure}_mean`` is their mean
    and ``{measure}_m2`` the sum of their squared deviations from it.
    """
    figures = []
    for m in series.measures:
        value = F.col(m).cast("double")
        figures += [
            F.count(value).alias(f"{m}_n"),
            F.avg(value).alias(f"{m}_mean"),
            (F.var_pop(value) * F.count(value)).alias(f"{m}_m2"),
        ]
    return placed.groupBy(series.entity, "hour", F.to_date(series.time).alias(DAY)).agg(*figures)


def _merged(measure: str) -> Column:
    """All days' moments of one measure as one: the exact merge of two, day after day."""
    start = F.struct(
        F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2")
    )

    def merge(a: Column, day: Column) -> Column:
        n, mean, m2 = (day[f"{measure}_{k}"] for k in ("n", "mean", "m2"))
        total, apart = a["n"] + n, mean - a["mean"]
        both = F.struct(
            total.alias("n"),
            (a["mean"] + apart * n / total).alias("mean"),
            (a["m2"] + m2 + apart * apart * a["n"] * n / total).alias("m2"),
        )
        return F.when(n > 0, both).otherwise(a)

    return F.aggregate("days", start, merge)


def merge_profile(moments: DataFrame, series: Series = TURBINES) -> DataFrame:
    """The profile of all days of ``moments``, with the columns of ``hourly_profile``.

    One row per entity and hour gathers its days in their order, so it is as long as
    the window has days, and the result does not depend on how tasks were dealt.
    """
    days = F.sort_array(F.collect_list(F.struct(DAY, *[f"{m}_{k}" for m in series.measures for k in ("n", "mean", "m2")])))
    gathered = moments.groupBy(series.entity, "hour").agg(days.alias("days"))
    merged = gathered.select(
        series.entity, "hour", *[_merged(m).alias(m) for m in series.measures]
    )
    return merged.select(
        series.entity,
        "hour",
        *[F.when(F.col(m)["n"] > 0, F.col(m)["mean"]).alias(f"{m}_mean") for m in series.measures],
        *[
            F.when(F.col(m)["n"] > 1, F.sqrt(F.col(m)["m2"] / (F.col(m)["n"] - 1))).alias(f"{m}_stddev")
            for m in series.measures
        ],
    )


def store_moments(
    spark: SparkSession, placed: DataFrame, table: str, days: Sequence[Instant], series: Series = TURBINES
) -> None:
    """Bring the moments of ``days`` in ``table``, one partition per day, up to date.

    ``placed`` holds all readings of those days and no others count. A day without
    readings loses the moments it had.
    """
    wanted = [F.lit(str(d)).cast("date") for d in days]
    with staged(daily_moments(placed, series).where(F.col(DAY).isin(wanted)), "moments") as fresh:
        if not table_exists(spark, table):
            save_table(rebalance(fresh, [DAY]), table, partitions=[DAY])
            return
        held = {str(r[0]) for r in spark.table(table).select(DAY).distinct().collect()}
        filled = {str(r[0]) for r in fresh.select(DAY).distinct().collect()}
        replace_partitions(rebalance(fresh, [DAY]), table)
        for day in sorted({str(d)[:10] for d in days} & held - filled):
            clear_partition(spark, table, {DAY: day})


def stored_profile(
    spark: SparkSession, table: str, first: Instant, last: Instant, series: Series = TURBINES
) -> DataFrame:
    """The profile of the stored days from ``first`` to ``last``, both included."""
    between = F.col(DAY).between(F.lit(str(first)[:10]).cast("date"), F.lit(str(last)[:10]).cast("date"))
    return merge_profile(spark.table(table).where(between), series)

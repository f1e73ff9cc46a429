"""The turbine job: load a window, score it, upsert three result tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierflow.operators.dedupe import remove_duplicates
from tierflow.operators.moments import store_moments, stored_profile
from tierflow.operators.timeseries import (
    TURBINES,
    Instant,
    Series,
    daily_statistics,
    find_anomalies,
    hourly_profile,
    on_grid,
    presence,
    process,
    replace_outliers,
    shared_slots,
)
from tierflow.sinks.upsert import upsert
from tierflow.sources.files import load_window
from tierflow.sources.zones import ZoneMap
from tierflow.staging import staged

Order = Sequence[Column | str] | None


@dataclass(frozen=True)
class Outputs:
    """Names of the result tables, and where their files go."""

    cleaned: str = "cleaned"
    anomalies: str = "anomalies"
    statistics: str = "statistics"
    file_format: str = "parquet"
    root: str | None = None

    @property
    def moments(self) -> str:
        """Stored moments of each day, for the daily job."""
        return f"{self.cleaned}__moments"

    @property
    def zones(self) -> str:
        """The time ranges of source files, for the daily job."""
        return f"{self.cleaned}__zones"

    @classmethod
    def within(cls, namespace: str, **options) -> Outputs:
        """The default table names inside ``catalog.schema`` or ``database``."""
        return cls(
            f"{namespace}.cleaned", f"{namespace}.anomalies", f"{namespace}.statistics",
            **options,
        )


def _store_readings(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    outputs: Outputs,
    series: Series,
    keys_are_unique: bool,
    dedupe_source_on: Order,
) -> None:
    """Upsert rows keyed by entity and time, in one partition per day."""
    upsert(
        spark,
        df.withColumn("date", F.to_date(series.time)),
        table,
        keys=[series.entity, series.time],
        partition_by=["date"],
        partition_from={"date": f"to_date(`{series.time}`)"},
        file_format=outputs.file_format,
        root=outputs.root,
        source_is_stored=True,
        keys_are_unique=keys_are_unique,
        dedupe_source_on=dedupe_source_on,
    )


def output_cleaned(
    spark: SparkSession,
    scored: DataFrame,
    outputs: Outputs = Outputs(),
    series: Series = TURBINES,
    keys_are_unique: bool = False,
    dedupe_source_on: Order = None,
) -> DataFrame:
    """Upsert the readings with outliers replaced, and return them.

    ``scored`` is read several times here and below; give a stored table.
    """
    cleaned = replace_outliers(scored, series)
    _store_readings(
        spark, cleaned, outputs.cleaned, outputs, series, keys_are_unique, dedupe_source_on
    )
    return cleaned


def output_anomalies(
    spark: SparkSession,
    scored: DataFrame,
    outputs: Outputs = Outputs(),
    series: Series = TURBINES,
    keys_are_unique: bool = False,
    dedupe_source_on: Order = None,
) -> None:
    """Upsert the anomalous readings."""
    _store_readings(
        spark, find_anomalies(scored, series), outputs.anomalies, outputs, series,
        keys_are_unique, dedupe_source_on,
    )


def output_statistics(
    spark: SparkSession,
    cleaned: DataFrame,
    outputs: Outputs = Outputs(),
    series: Series = TURBINES,
) -> None:
    """Upsert the daily statistics of cleaned readings."""
    upsert(
        spark,
        daily_statistics(cleaned, series),
        outputs.statistics,
        keys=[series.entity, "date"],
        partition_by=["date"],
        file_format=outputs.file_format,
        root=outputs.root,
        keys_are_unique=True,
    )


def run_outputs(
    spark: SparkSession,
    readings: DataFrame,
    start: Instant,
    end: Instant,
    outputs: Outputs = Outputs(),
    series: Series = TURBINES,
    dedupe_source_on: Order = None,
) -> None:
    """Score stored readings and bring all three tables up to date.

    Several readings on one slot are an error before anything is written, unless
    ``dedupe_source_on`` says by which order one of them counts; the others then
    enter neither the profile nor the statistics.

    The profile is staged so that the join with it is planned on its real
    size, and the scored table because three outputs read it, some of them
    more than once.
    """
    if dedupe_source_on:
        single = remove_duplicates(
            on_grid(readings, start, end, series).select(*readings.columns),
            [series.entity, series.time],
            dedupe_source_on,
        )
        with staged(single, "single-readings") as stored:
            run_outputs(spark, stored, start, end, outputs, series)
        return
    profile = hourly_profile(on_grid(readings, start, end, series), series)
    with _single_presence(readings, start, end, series) as seen, staged(profile, "profile") as stored:
        _score(spark, readings, start, end, outputs, series, stored, seen)


@contextmanager
def _single_presence(
    readings: DataFrame, start: Instant, end: Instant, series: Series
) -> Iterator[DataFrame]:
    """The stored presence of readings, of which no two share a slot."""
    with staged(presence(readings, start, end, series), "presence") as seen:
        shared = shared_slots(readings, start, end, series, seen).limit(1).collect()
        if shared:
            raise ValueError(f"several readings share one key: {shared[0].asDict()}")
        yield seen


def _score(
    spark: SparkSession,
    readings: DataFrame,
    start: Instant,
    end: Instant,
    outputs: Outputs,
    series: Series,
    profile: DataFrame,
    seen: DataFrame,
) -> None:
    with staged(process(readings, start, end, series, profile, seen), "scored") as stored:
        cleaned = output_cleaned(spark, stored, outputs, series, keys_are_unique=True)
        output_anomalies(spark, stored, outputs, series, keys_are_unique=True)
        output_statistics(spark, cleaned, outputs, series)


def run_turbines(
    spark: SparkSession,
    path: str | list[str],
    start: Instant,
    end: Instant,
    outputs: Outputs = Outputs(),
    series: Series = TURBINES,
    schema: StructType | str | None = None,
    dedupe_source_on: Order = None,
) -> None:
    """Load CSV readings of a window and bring all three tables up to date.

    The text is parsed once; everything after reads the staged columns.
    """
    loaded = load_window(spark, path, start, end, schema, series.time)
    with staged(loaded.select(*series.columns), "readings") as readings:
        run_outputs(spark, readings, start, end, outputs, series, dedupe_source_on)


# --- a day at a time -------------------------------------------------------


@contextmanager
def _readings_of(
    spark: SparkSession,
    path: str | list[str],
    start: datetime,
    end: datetime,
    outputs: Outputs,
    series: Series,
    schema: StructType | str,
    dedupe_source_on: Order,
) -> Iterator[DataFrame]:
    """Stored readings of ``[start, end)``, at most one per slot if an order is given."""
    zones = ZoneMap(spark, outputs.zones, series.time)
    with zones.window(path, start, end - timedelta(hours=1), schema) as found:
        rows = found.rows.select(*series.columns)
        if dedupe_source_on:
            placed = on_grid(rows, start, end, series).select(*series.columns)
            rows = remove_duplicates(placed, [series.entity, series.time], dedupe_source_on)
        with staged(rows, "readings") as readings:
            yield readings


def refresh_moments(
    spark: SparkSession,
    path: str | list[str],
    first: date,
    last: date,
    schema: StructType | str,
    outputs: Outputs = Outputs(),
    series: Series = TURBINES,
    dedupe_source_on: Order = None,
) -> None:
    """Store the moments of the days from ``first`` to ``last``, both included.

    For days that have come before the daily job began, or were corrected since.
    """
    start, end = _midnight(first), _midnight(last) + timedelta(days=1)
    days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    with (
        _readings_of(spark, path, start, end, outputs, series, schema, dedupe_source_on) as readings,
        _single_presence(readings, start, end, series),
    ):
        store_moments(spark, on_grid(readings, start, end, series), outputs.moments, days, series)


def run_turbines_daily(
    spark: SparkSession,
    path: str | list[str],
    day: date,
    days: int,
    schema: StructType | str,
    outputs: Outputs = Outputs(),
    series: Series = TURBINES,
    dedupe_source_on: Order = None,
) -> None:
    """Bring the three tables up to date with one day, scored as part of its window.

    The profile is that of the ``days`` days that end with ``day``, merged from
    stored moments; readings are read of ``day`` alone, from the files that may hold
    some. The rows of ``day`` are those that ``run_turbines`` over the whole window
    gives; earlier days keep the scores they were given in their own run. Entities
    that have readings on the grid anywhere in the window get a grid for the day.
    """
    start = _midnight(day)
    end, first = start + timedelta(days=1), day - timedelta(days=days - 1)
    with _readings_of(spark, path, start, end, outputs, series, schema, dedupe_source_on) as readings:
        with _single_presence(readings, start, end, series) as seen:
            store_moments(spark, on_grid(readings, start, end, series), outputs.moments, [day], series)
            profile = stored_profile(spark, outputs.moments, first, day, series)
            with staged(profile, "profile") as stored:
                # Entities without a reading today are seen, in no block.
                absent = stored.select(series.entity).distinct().join(seen, series.entity, "left_anti")
                every = seen.unionByName(absent, allowMissingColumns=True)
                _score(spark, readings, start, end, outputs, series, stored, every)


def _midnight(day: date) -> datetime:
    return datetime(day.year, day.month, day.day)

"""Hourly series per entity: gaps, profiles, imputation, scores, outliers.

The complete grid of a window has one slot per entity and hour of
``[start, end)``. Joining every reading to that grid would shuffle all readings
on (time, entity). It is not needed: a reading belongs to the grid exactly when
its time is a slot, which a narrow filter decides, and only the slots *without*
a reading have to be found. Those come from one presence bitmap per entity and
day, so what is shuffled is bounded by entities x days, not by readings, and
copies of a reading collapse before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.scalar import absolute_zscore, replace_beyond

# Slots per presence bitmap; a bitmap is one 64-bit integer.
BLOCK = 24

Instant = datetime | date | str


@dataclass(frozen=True)
class Series:
    """Which columns make up a series, and its thresholds."""

    entity: str = "turbine_id"
    time: str = "timestamp"
    measures: tuple[str, ...] = ("wind_speed", "wind_direction", "power_output")
    outlier_limit: float = 3.0
    anomaly_measure: str = "power_output"
    anomaly_limit: float = 2.0

    @property
    def columns(self) -> list[str]:
        return [self.time, self.entity, *self.measures]


TURBINES = Series()


# --- the hourly grid -------------------------------------------------------


def _as_datetime(value: Instant) -> datetime:
    if isinstance(value, str):
        return datetime.fromisoformat(value)
    if isinstance(value, datetime):
        return value
    return datetime(value.year, value.month, value.day)


def _window(start: Instant, end: Instant) -> tuple[datetime, datetime]:
    first, last = _as_datetime(start), _as_datetime(end)
    if last <= first:
        raise ValueError(f"the window is empty: start {first} is not before end {last}")
    return first, last


def _literal(value: datetime, data_type: str) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast(data_type)


def _time_type(df: DataFrame, series: Series) -> str:
    data_type = dict(df.dtypes)[series.time]
    if data_type not in ("timestamp", "timestamp_ntz"):
        raise ValueError(f"{series.time} must be a timestamp, not {data_type}")
    return data_type


def _bounds(start: datetime, end: datetime, data_type: str) -> tuple[Column, Column]:
    """First slot, and the time no slot lies beyond."""
    return _literal(start, data_type), _literal(end - timedelta(hours=1), data_type)


def _slot_times(start: datetime, end: datetime, data_type: str) -> Column:
    """All slots as an array; a window under one hour has none."""
    if end - start < timedelta(hours=1):
        return F.array().cast(f"array<{data_type}>")
    return F.sequence(*_bounds(start, end, data_type), F.expr("INTERVAL 1 HOUR"))


def _hours_since(time: Column, start: Column, data_type: str) -> Column:
    """Whole hours from ``start``, rounded down for a time between two slots."""
    if data_type == "timestamp":
        return F.floor((F.unix_micros(time) - F.unix_micros(start)) / 3_600_000_000)
    days = F.date_diff(F.to_date(time), F.to_date(start))
    return (days * 24 + F.hour(time) - F.hour(start)).cast("long")


def _slot_time(hours: Column, start: Column, data_type: str) -> Column:
    if data_type == "timestamp":
        return F.timestamp_micros(F.unix_micros(start) + hours * 3_600_000_000)
    return F.timestamp_add("HOUR", hours.cast("int"), start)


def _is_slot(
    readings: DataFrame, start: datetime, end: datetime, series: Series
) -> Column:
    """Whether a reading falls on a slot of its entity.

    The plain range is the part a file scan can push down; past the hour, a
    slot agrees with the start. An entity that is null never equals itself, so
    its readings match no slot.
    """
    data_type = _time_type(readings, series)
    time = F.col(series.time)
    first, last = _bounds(start, end, data_type)
    if data_type == "timestamp":
        exact = (F.unix_micros(time) - F.unix_micros(first)) % 3_600_000_000 == 0
    else:
        second = F.lit(Decimal(start.second) + Decimal(start.microsecond).scaleb(-6))
        exact = (F.minute(time) == start.minute) & (
            F.extract(F.lit("SECOND"), time) == second
        )
    return time.between(first, last) & exact & F.col(series.entity).isNotNull()


def hourly_timestamps(
    spark: SparkSession,
    start: Instant,
    end: Instant,
    time: str = "timestamp",
    data_type: str = "timestamp",
) -> DataFrame:
    """Every hour of ``[start, end)``, with its hour of day."""
    first, last = _window(start, end)
    return (
        spark.range(1)
        .select(F.explode(_slot_times(first, last, data_type)).alias(time))
        .withColumn("hour", F.hour(time))
    )


def _spread(df: DataFrame, column: str) -> DataFrame:
    """Repartition few rows that are about to be expanded into many.

    The count is given so that adaptive execution does not merge the still
    small partitions back into one task.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, column)


def distinct_entities(readings: DataFrame, series: Series = TURBINES) -> DataFrame:
    """The entities that have any reading."""
    return readings.select(series.entity).distinct()


def entity_grid(
    readings: DataFrame, start: Instant, end: Instant, series: Series = TURBINES
) -> DataFrame:
    """Every hour of the window for every entity."""
    first, last = _window(start, end)
    slots = _slot_times(first, last, _time_type(readings, series))
    entities = _spread(distinct_entities(readings, series), series.entity)
    return entities.select(F.explode(slots).alias(series.time), series.entity).select(
        series.time, F.hour(series.time).alias("hour"), series.entity
    )


def on_grid(
    readings: DataFrame, start: Instant, end: Instant, series: Series = TURBINES
) -> DataFrame:
    """The readings that fall on a slot, with their hour of day. No shuffle."""
    if "hour" in readings.columns:
        raise ValueError("readings already have a column named hour")
    first, last = _window(start, end)
    others = [c for c in readings.columns if c not in (series.time, series.entity)]
    return readings.where(_is_slot(readings, first, last, series)).select(
        series.time, series.entity, F.hour(series.time).alias("hour"), *others
    )


def presence(
    readings: DataFrame, start: Instant, end: Instant, series: Series = TURBINES
) -> DataFrame:
    """Per entity and block: bitmap of the slots with a reading, and their number.

    Entities whose readings all lie off the grid keep a row, with no block.
    ``shared_slots`` and ``missing_slots`` both follow from it; store it for both.
    """
    start, end = _window(start, end)
    data_type = _time_type(readings, series)
    slot = _hours_since(F.col(series.time), _literal(start, data_type), data_type)
    return (
        readings.select(
            series.entity,
            F.when(_is_slot(readings, start, end, series), slot).alias("slot"),
        )
        .groupBy(series.entity, F.expr(f"slot div {BLOCK}").alias("block"))
        .agg(
            F.bit_or(F.expr(f"shiftleft(1L, int(slot % {BLOCK}))")).alias("present"),
            F.count("slot").alias("readings"),
        )
    )


def shared_slots(
    readings: DataFrame,
    start: Instant,
    end: Instant,
    series: Series = TURBINES,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Entities, and when a block begins in which readings share a slot.

    A block with more readings than slots used has copies. This needs no
    shuffle of the readings' keys.
    """
    first, last = _window(start, end)
    data_type = _time_type(readings, series)
    seen = presence(readings, first, last, series) if seen is None else seen
    return (
        seen.where(F.col("readings") > F.bit_count("present"))
        .select(
            series.entity,
            _slot_time(
                F.col("block") * BLOCK, _literal(first, data_type), data_type
            ).alias(series.time),
        )
    )


def missing_slots(
    readings: DataFrame,
    start: Instant,
    end: Instant,
    series: Series = TURBINES,
    seen: DataFrame | None = None,
) -> DataFrame:
    """The slots for which an entity has no reading: time, entity, hour.

    ``seen`` is the stored ``presence`` of the readings, if there is one.
    """
    return _empty_slots(readings, start, end, series, seen).drop("carried")


def _empty_slots(
    readings: DataFrame,
    start: Instant,
    end: Instant,
    series: Series,
    seen: DataFrame | None,
    carried: DataFrame | None = None,
) -> DataFrame:
    """``missing_slots`` with what ``carried`` has for their entity, or null, beside them."""
    first, last = _window(start, end)
    data_type = _time_type(readings, series)
    entity, start_at = F.col(series.entity), _literal(first, data_type)
    count = F.size(_slot_times(first, last, data_type)).cast("long")
    seen = presence(readings, first, last, series) if seen is None else seen

    # One row per entity holding its blocks: bounded by the days of the window.
    per_entity = (
        _spread(seen.drop("readings"), series.entity)
        .groupBy(entity)
        .agg(F.collect_list(F.struct("block", "present")).alias("blocks"))
    )
    if carried is None:
        per_entity = per_entity.withColumn("carried", F.lit(None))
    else:
        per_entity = per_entity.join(carried, series.entity, "left")
    used = F.filter("blocks", lambda b: b["block"].isNotNull())
    all_blocks = F.filter(
        F.sequence(F.lit(0).cast("long"), F.floor(count / BLOCK)),
        lambda b: b * BLOCK < count,
    )
    unused = F.transform(
        F.array_except(all_blocks, F.transform(used, lambda b: b["block"])),
        lambda b: F.struct(b.alias("block"), F.lit(0).cast("long").alias("present")),
    )
    blocks = per_entity.select(entity, "carried", F.explode(F.concat(used, unused)).alias("b"))

    offset = F.col("b")["block"] * BLOCK
    empty = F.filter(
        F.sequence(F.lit(0), F.lit(BLOCK - 1)),
        lambda i: (F.getbit(F.col("b")["present"], i) == 0) & (offset + i < count),
    )
    return (
        blocks.select(entity, "carried", offset.alias("offset"), F.explode(empty).alias("i"))
        .select(
            _slot_time(F.col("offset") + F.col("i"), start_at, data_type).alias(series.time),
            entity,
            "carried",
        )
        .select(series.time, series.entity, F.hour(series.time).alias("hour"), "carried")
    )


def complete_grid(
    readings: DataFrame, start: Instant, end: Instant, series: Series = TURBINES
) -> DataFrame:
    """The grid left-joined with the readings.

    Slots without a reading appear with nulls, readings off the grid are left
    out, and several readings on one slot all stay.
    """
    return on_grid(readings, start, end, series).unionByName(
        missing_slots(readings, start, end, series), allowMissingColumns=True
    )


# --- profiles, imputation and scores --------------------------------------


def hourly_profile(df: DataFrame, series: Series = TURBINES) -> DataFrame:
    """Mean and sample deviation of each measure per entity and hour of day."""
    return df.groupBy(series.entity, "hour").agg(
        *[F.avg(m).alias(f"{m}_mean") for m in series.measures],
        *[F.stddev_samp(m).alias(f"{m}_stddev") for m in series.measures],
    )


def attach_profile(
    df: DataFrame, profile: DataFrame, series: Series = TURBINES
) -> DataFrame:
    """Add to every row the profile of its entity and hour."""
    return df.join(profile, on=[series.entity, "hour"], how="left")


def _profiled_slots(
    readings: DataFrame,
    start: Instant,
    end: Instant,
    series: Series,
    profile: DataFrame,
    seen: DataFrame | None,
) -> DataFrame:
    """The missing slots with the profile of their entity and hour.

    The profile is joined as one row per entity, before its slots are made, so that
    slots are neither shuffled nor sorted, however many there are to a reading.
    """
    names = [c for c in profile.columns if c not in (series.entity, "hour")]
    hours = profile.groupBy(series.entity).agg(
        F.collect_list(F.struct("hour", *names)).alias("hours")
    )
    by_hour = F.transform(
        F.sequence(F.lit(0), F.lit(23)),
        lambda i: F.get(F.filter("hours", lambda h: h["hour"] == i), F.lit(0)),
    )
    slots = _empty_slots(
        readings, start, end, series, seen, hours.select(series.entity, by_hour.alias("carried"))
    )
    own = F.get("carried", F.col("hour"))
    return slots.select(
        series.time, series.entity, "hour", *[own[c].alias(c) for c in names]
    )


def fill_from_profile(df: DataFrame, series: Series = TURBINES) -> DataFrame:
    """Put the profile mean where a measure is null."""
    return df.withColumns(
        {m: F.coalesce(F.col(m), F.col(f"{m}_mean")) for m in series.measures}
    )


def impute(
    readings: DataFrame,
    start: Instant,
    end: Instant,
    series: Series = TURBINES,
    profile: DataFrame | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Complete the grid and fill its gaps from the hour-of-day profile.

    The profile is taken from the readings on the grid, since slots without a
    reading add nothing to a mean or a deviation. The readings are read three
    times, so give a stored table; pass ``profile`` to use one that is stored too,
    which lets the join with it be planned on its real size, and their stored
    ``presence`` as ``seen``.
    """
    placed = on_grid(readings, start, end, series)
    if profile is None:
        profile = hourly_profile(placed, series)
    completed = attach_profile(placed, profile, series).unionByName(
        _profiled_slots(readings, start, end, series, profile, seen), allowMissingColumns=True
    )
    return fill_from_profile(completed, series)


def add_zscores(df: DataFrame, series: Series = TURBINES) -> DataFrame:
    """Add the absolute z-score of each measure against its profile."""
    return df.withColumns(
        {
            f"{m}_zscore": absolute_zscore(
                F.col(m), F.col(f"{m}_mean"), F.col(f"{m}_stddev")
            )
            for m in series.measures
        }
    )


def process(
    readings: DataFrame,
    start: Instant,
    end: Instant,
    series: Series = TURBINES,
    profile: DataFrame | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Imputed and scored readings: the table all three outputs derive from."""
    return add_zscores(impute(readings, start, end, series, profile, seen), series)


def replace_outliers(scored: DataFrame, series: Series = TURBINES) -> DataFrame:
    """Put the profile mean where a score exceeds the outlier limit."""
    return scored.select(
        series.time,
        series.entity,
        *[
            replace_beyond(
                F.col(m), F.col(f"{m}_zscore"), series.outlier_limit, F.col(f"{m}_mean")
            ).alias(m)
            for m in series.measures
        ],
    )


def find_anomalies(scored: DataFrame, series: Series = TURBINES) -> DataFrame:
    """Readings whose watched measure scores above the anomaly limit.

    Values are the imputed ones; outliers among them are not replaced.
    """
    return scored.where(
        F.col(f"{series.anomaly_measure}_zscore") > series.anomaly_limit
    ).select(*series.columns)


def daily_statistics(
    cleaned: DataFrame, series: Series = TURBINES, measure: str | None = None
) -> DataFrame:
    """Minimum, maximum and mean of a measure per entity and calendar day."""
    measure = measure or series.anomaly_measure
    return cleaned.groupBy(F.to_date(series.time).alias("date"), series.entity).agg(
        F.min(measure).alias(f"{measure}_min"),
        F.max(measure).alias(f"{measure}_max"),
        F.avg(measure).alias(f"{measure}_avg"),
    )

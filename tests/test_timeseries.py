from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from support import explained, rows
from tierflow.operators import timeseries as ts

SCHEMA = (
    "timestamp {time}, turbine_id string, wind_speed double, "
    "wind_direction double, power_output double"
)
DAY = datetime(2024, 1, 1)


def readings(spark, data, time="timestamp_ntz"):
    """Rows of (time, entity, value); the value is used for all measures."""
    full = [(at, entity, value, value, value) for at, entity, value in data]
    df = spark.createDataFrame(full, SCHEMA.format(time="timestamp_ntz"))
    return df.withColumn("timestamp", F.col("timestamp").cast(time))


def at(day, hour, minute=0):
    return DAY + timedelta(days=day, hours=hour, minutes=minute)


def series_of(values, hour=5, entity="t"):
    return [(at(d, hour), entity, v) for d, v in enumerate(values) if v is not None]


def scored(spark, data, days, **kwargs):
    return ts.process(readings(spark, data, **kwargs), DAY, DAY + timedelta(days=days))


def slot(df, day, hour=5):
    return df.where(F.col("timestamp") == F.lit(str(at(day, hour))).cast("timestamp_ntz"))


def test_hourly_timestamps_exclude_the_end(spark):
    df = ts.hourly_timestamps(spark, "2024-01-01", "2024-01-03")
    assert df.count() == 48
    assert df.agg(F.max("timestamp")).first()[0] == datetime(2024, 1, 2, 23)
    assert [r["hour"] for r in df.orderBy("timestamp").limit(25).collect()][-2:] == [23, 0]


def test_window_edges(spark):
    with pytest.raises(ValueError, match="empty"):
        ts.hourly_timestamps(spark, "2024-01-02", "2024-01-01")
    assert ts.hourly_timestamps(spark, DAY, DAY + timedelta(minutes=30)).count() == 0
    # The last slot is the last one a full hour before the end.
    assert ts.hourly_timestamps(spark, DAY, DAY + timedelta(minutes=150)).count() == 2


@pytest.mark.parametrize("time", ["timestamp_ntz", "timestamp"])
def test_gap_is_filled_from_the_hour_of_day(spark, time):
    df = scored(spark, series_of([10.0, None, 20.0]), 3, time=time)
    assert df.count() == 72
    filled = slot(df, 1).first()
    assert filled["power_output"] == 15.0
    assert filled["power_output_zscore"] == 0.0


def test_hour_without_any_reading_stays_null(spark):
    df = scored(spark, series_of([10.0, 11.0, 20.0]), 3)
    row = slot(df, 1, hour=6).first()
    assert row["power_output"] is None and row["power_output_zscore"] is None
    assert ts.find_anomalies(df).count() == 0


def test_one_day_flags_nothing(spark):
    data = [(at(0, h), "t", 1000.0 if h == 3 else 1.0) for h in range(24)]
    df = scored(spark, data, 1)
    assert df.where("power_output_stddev is not null").count() == 0
    assert ts.find_anomalies(df).count() == 0
    assert rows(ts.replace_outliers(df), "power_output") == rows(df, "power_output")


def test_zero_deviation_gives_no_score_and_no_error(spark):
    df = scored(spark, series_of([7.0, 7.0, 7.0]), 3)
    row = slot(df, 1).first()
    assert (row["power_output"], row["power_output_zscore"]) == (7.0, None)
    assert slot(ts.replace_outliers(df), 1).first()["power_output"] == 7.0


def test_outlier_bound(spark):
    ten = scored(spark, series_of([1.0] * 10 + [100.0]), 11)
    outlier = slot(ten, 10).first()
    assert outlier["power_output_zscore"] == pytest.approx(3.015, abs=1e-3)
    assert slot(ts.replace_outliers(ten), 10).first()["power_output"] == 10.0
    # The anomaly keeps the value that the cleaned reading loses.
    assert rows(ts.find_anomalies(ten), "power_output") == [(100.0,)]

    nine = scored(spark, series_of([1.0] * 9 + [100.0]), 10)
    assert slot(nine, 9).first()["power_output_zscore"] == pytest.approx(2.846, abs=1e-3)
    assert slot(ts.replace_outliers(nine), 9).first()["power_output"] == 100.0
    assert ts.find_anomalies(nine).count() == 1


def test_readings_off_the_grid_drop_but_their_entity_counts(spark):
    data = [(at(0, 5, minute=30), "late", 1.0), (at(1, 0), "end", 2.0), (at(0, 3), "t", 3.0)]
    grid = ts.complete_grid(readings(spark, data), DAY, DAY + timedelta(days=1))
    assert grid.count() == 72
    assert rows(grid.where("power_output is not null"), "turbine_id") == [("t",)]


def test_null_entity_has_only_gaps(spark):
    data = [(at(0, 3), None, 3.0), (at(0, 3), "t", 4.0)]
    grid = ts.complete_grid(readings(spark, data), DAY, DAY + timedelta(days=1))
    assert grid.where("turbine_id is null").count() == 24
    assert grid.where("turbine_id is null and power_output is not null").count() == 0


def test_copies_of_a_reading_all_stay(spark):
    data = [(at(0, 3), "t", 1.0), (at(0, 3), "t", 1.0), (at(0, 3), "t", 4.0)]
    df = readings(spark, data)
    grid = ts.complete_grid(df, DAY, DAY + timedelta(days=1))
    assert grid.count() == 26
    profile = ts.hourly_profile(grid).where("hour = 3").first()
    assert profile["power_output_mean"] == 2.0


def test_shared_slots(spark):
    data = [(at(0, 3), "t", 1.0), (at(1, 4), "t", 1.0), (at(1, 4), "t", 2.0),
            (at(1, 5), None, 1.0), (at(1, 5), None, 1.0), (at(1, 5, 30), "u", 1.0),
            (at(1, 5, 30), "u", 1.0)]
    shared = ts.shared_slots(readings(spark, data), DAY, DAY + timedelta(days=2))
    assert rows(shared) == [("t", at(1, 0))]


def test_further_columns_are_carried(spark):
    df = readings(spark, [(at(0, 3), "t", 1.0)]).withColumn("temperature", F.lit(9))
    grid = ts.complete_grid(df, DAY, DAY + timedelta(days=1))
    assert rows(grid.where("temperature is not null"), "temperature") == [(9,)]
    with pytest.raises(ValueError, match="hour"):
        ts.complete_grid(df.withColumn("hour", F.lit(1)), DAY, DAY + timedelta(days=1))


def test_grid_that_starts_within_the_hour(spark):
    start = DAY + timedelta(minutes=15)
    data = [(at(0, 3, 15), "t", 1.0), (at(0, 4), "t", 2.0)]
    grid = ts.complete_grid(readings(spark, data), start, start + timedelta(hours=30))
    assert grid.count() == 30
    assert rows(grid.where("power_output is not null"), "hour") == [(3,)]


def test_clock_change_keeps_hours_apart(spark):
    """Zoned times are an hour apart in elapsed time, also when clocks go back."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        start, end = "2024-10-27", "2024-10-28"
        hours = ts.hourly_timestamps(spark, start, end)
        assert hours.count() == 25
        df = spark.sql(
            "select timestamp'2024-10-27 00:30:00 UTC' - interval 30 minutes as timestamp, "
            "'t' as turbine_id, 1.0D as wind_speed, 1.0D as wind_direction, 1.0D as power_output"
        )
        gaps = ts.missing_slots(df, start, end)
        assert gaps.count() == 24
        assert ts.complete_grid(df, start, end).select("timestamp").distinct().count() == 25
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_daily_statistics(spark):
    df = readings(spark, [(at(0, 1), "t", 1.0), (at(0, 2), "t", 5.0), (at(1, 0), "t", 9.0)])
    result = ts.daily_statistics(df)
    assert [r[2:] for r in rows(result)] == [(1.0, 5.0, 3.0), (9.0, 9.0, 9.0)]


def textbook(df, start, end):
    """The grid join as one would write it first."""
    grid = ts.hourly_timestamps(df.sparkSession, start, end, data_type="timestamp_ntz")
    grid = grid.crossJoin(df.select("turbine_id").distinct())
    completed = grid.join(df, on=["timestamp", "turbine_id"], how="left")
    profile = ts.hourly_profile(completed)
    joined = completed.join(profile, on=["turbine_id", "hour"], how="left")
    return ts.add_zscores(ts.fill_from_profile(joined))


READING = st.tuples(
    st.integers(-3, 75),
    st.sampled_from([0, 0, 0, 0, 30]),
    st.sampled_from(["a", "b", None]),
    st.one_of(st.none(), st.integers(0, 9)),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(READING, max_size=60), st.integers(1, 70))
def test_process_equals_the_textbook_join(spark, sample, hours):
    data = [
        (DAY + timedelta(hours=h, minutes=m), e, None if v is None else float(v))
        for h, m, e, v in sample
    ]
    df = readings(spark, data).coalesce(2)
    end = DAY + timedelta(hours=hours)
    columns = sorted(ts.process(df, DAY, end).columns)
    assert rounded(ts.process(df, DAY, end), columns) == rounded(textbook(df, DAY, end), columns)


def rounded(df, columns):
    doubles = {c for c, t in df.dtypes if t == "double"}
    return rows(df.select(*[F.round(c, 6).alias(c) if c in doubles else c for c in columns]))


def test_large_profile_is_joined_without_broadcast(spark):
    """Above the broadcast limit the profile is staged and the join shuffles."""
    data = [(at(d, h), f"t{e}", float(d * h + e)) for d in range(3) for h in range(24) for e in range(9)]
    df, end = readings(spark, data), DAY + timedelta(days=3)
    expected = rows(ts.process(df, DAY, end).select(*sorted(ts.process(df, DAY, end).columns)))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = ts.process(df, DAY, end)
        assert "SortMergeJoin" in result._jdf.queryExecution().executedPlan().toString()
        assert rows(result.select(*sorted(result.columns))) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_readings_are_not_shuffled_when_the_profile_is_small(spark, tmp_path):
    path = str(tmp_path / "readings")
    readings(spark, series_of([10.0, None, 20.0])).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = explained(ts.on_grid(stored, DAY, DAY + timedelta(days=3)))
    assert "Exchange" not in plan
    assert "GreaterThanOrEqual(timestamp,2024-01-01T00:00)" in plan


def test_only_presence_bitmaps_are_shuffled(spark, tmp_path):
    path = str(tmp_path / "readings")
    readings(spark, series_of([10.0, None, 20.0])).write.parquet(path)
    gaps = ts.missing_slots(spark.read.parquet(path), DAY, DAY + timedelta(days=3))
    plan = explained(gaps)
    assert plan.count("Exchange (") == 2
    assert "ReadSchema: struct<timestamp:timestamp_ntz,turbine_id:string>" in plan


def test_slots_are_made_after_the_profile_is_joined(spark):
    """No join sorts or shuffles the slots without a reading, which may be many to a reading."""
    data = [(at(d, h), e, float(d * h)) for d, h, e in ((0, 5, "a"), (1, 5, "a"), (2, 7, "b"))]
    data += [(at(0, 5, 30), "off", 1.0), (at(1, 5), None, 1.0)]
    result = scored(spark, data, 3)
    depths, joins = [], 0
    for line in result._jdf.queryExecution().optimizedPlan().toString().splitlines():
        name = line.lstrip(" :+-")
        depth = len(line) - len(name)
        depths = [d for d in depths if d < depth]
        if name.startswith("Join"):
            depths.append(depth)
            joins += 1
        assert not (name.startswith("Generate") and depths)
    assert joins == 2
    found = {(r.turbine_id, r.timestamp): r.power_output for r in result.collect()}
    assert len(found) == result.count() == 4 * 72
    for (entity, time), value in found.items():
        hours = {("a", 5): 2.5, ("b", 7): 14.0}
        if (time, entity) not in {(t, e) for t, e, _ in data}:
            assert value == hours.get((entity, time.hour))

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from support import rows
from tierflow.operators import timeseries as ts
from tierflow.operators.observe import Watch
from tierflow.plans import layers, turbine
from tierflow.plans.specs import turbine_specs
from tierflow.streaming import ingest as ingest_module
from tierflow.streaming.ingest import ingest_new_files, ledger_of

CSV_SCHEMA = (
    "timestamp timestamp, turbine_id int, wind_speed double, "
    "wind_direction double, power_output double"
)
DAY = datetime(2024, 1, 1)


def write_readings(folder, name, turbine_id, days, broken=False):
    """Hourly readings with a gap, an outlier and, if asked, a bad row."""
    lines = ["timestamp,turbine_id,wind_speed,wind_direction,power_output"]
    for hour in range(24 * days):
        if hour % 50 == 7:
            continue
        value = 500.0 if hour == 24 * (days - 1) + 3 else 10.0 + (hour // 24) % 3
        at = DAY + timedelta(hours=hour)
        lines.append(f"{at:%Y-%m-%d %H:%M:%S},{turbine_id},{value},90.0,{value}")
    (folder / name).write_text("\n".join(lines) + "\n")


# --- turbine job -----------------------------------------------------------


@pytest.fixture
def turbine_files(tmp_path):
    write_readings(tmp_path, "g1.csv", 1, 12)
    write_readings(tmp_path, "g2.csv", 2, 12)
    return f"{tmp_path}/*.csv"


def test_turbine_job(spark, database, turbine_files):
    outputs = turbine.Outputs.within(database)
    end = DAY + timedelta(days=12)
    turbine.run_turbines(spark, turbine_files, DAY, end, outputs, schema=CSV_SCHEMA)

    cleaned = spark.table(outputs.cleaned)
    assert cleaned.count() == 2 * 12 * 24
    assert cleaned.where("power_output is null or power_output > 100").count() == 0
    # The stored anomaly keeps the value the cleaned reading lost.
    anomalies = spark.table(outputs.anomalies).where("power_output > 100")
    assert rows(anomalies, "turbine_id", "power_output") == [(1, 500.0), (2, 500.0)]
    statistics = spark.table(outputs.statistics)
    assert statistics.count() == 24
    assert statistics.agg(F.max("power_output_max")).first()[0] < 100

    stored = [rows(spark.table(t)) for t in (outputs.cleaned, outputs.anomalies, outputs.statistics)]
    turbine.run_turbines(spark, turbine_files, DAY, end, outputs, schema=CSV_SCHEMA)
    again = [rows(spark.table(t)) for t in (outputs.cleaned, outputs.anomalies, outputs.statistics)]
    assert again == stored


def test_turbine_job_infers_the_schema(spark, database, tmp_path):
    write_readings(tmp_path, "g1.csv", 1, 2)
    outputs = turbine.Outputs.within(database)
    turbine.run_turbines(spark, f"{tmp_path}/*.csv", "2024-01-01", "2024-01-02", outputs)
    assert spark.table(outputs.cleaned).count() == 24


def test_output_cleaned_returns_the_table(spark, database, turbine_files):
    readings = spark.read.csv(turbine_files, header=True, schema=CSV_SCHEMA)
    scored = ts.process(readings, DAY, DAY + timedelta(days=12))
    outputs = turbine.Outputs.within(database)
    cleaned = turbine.output_cleaned(spark, scored, outputs)
    assert cleaned.columns == list(ts.TURBINES.columns)
    assert rows(cleaned) == rows(spark.table(outputs.cleaned).drop("date"))


def test_duplicate_readings_stop_the_job(spark, database, turbine_files, tmp_path):
    write_readings(tmp_path, "copy.csv", 1, 12)
    outputs = turbine.Outputs.within(database)
    with pytest.raises(ValueError, match="share one key"):
        turbine.run_turbines(
            spark, turbine_files, DAY, DAY + timedelta(days=12), outputs, schema=CSV_SCHEMA
        )
    assert not spark.catalog.tableExists(outputs.cleaned)
    turbine.run_turbines(
        spark, turbine_files, DAY, DAY + timedelta(days=12), outputs,
        schema=CSV_SCHEMA, dedupe_source_on=["power_output"],
    )
    assert spark.table(outputs.cleaned).count() == 2 * 12 * 24


# --- layered job -----------------------------------------------------------


def specs(database, path):
    bronze, silver, gold = turbine_specs(path, database)
    for spec in (bronze, silver, gold):
        spec["audit"] = {
            "audit_table": f"{database}.audit", "error_table": f"{database}.errors"
        }
    return bronze, silver, gold


@pytest.fixture
def layer_files(tmp_path):
    (tmp_path / "a.csv").write_text(
        "timestamp,Turbine_ID,wind_speed,power_output,temperature\n"
        "2024-01-01 00:00:00,T1,0.0,5.0,10.0\n"
        "2024-01-01 01:00:00,T1,4.0,8.0,12.0\n"
        "2024-01-01 02:00:00,T1,,0.0,70.0\n"
        "2024-01-01 03:00:00, T2 ,5.0,0.0,12.0\n"
        "2024-01-01 03:00:00, T2 ,5.0,0.0,12.0\n"
    )
    return f"{tmp_path}/*.csv"


def test_layers_with_the_turbine_specs(spark, database, layer_files):
    bronze, silver, gold = layers.run_layers(spark, *specs(database, layer_files))

    assert (bronze.source_count, bronze.target_count) == (5, 5)
    stored = spark.table(bronze.table)
    assert {"turbine_id", "load_timestamp", "source_file", "year", "month"} <= set(stored.columns)

    assert (silver.source_count, silver.target_count) == (5, 4)
    clean = spark.table(silver.table)
    assert rows(clean.select("turbine_id").distinct()) == [("t1",), ("t2",)]
    efficiency = {r[0] for r in rows(clean.where("power_output > 0"), "power_efficiency")}
    assert efficiency == {None, 2.0}
    failed = {
        (r["column_name"], r["rule"]): r["violations"]
        for r in silver.quality.where("not passed").collect()
    }
    assert failed == {
        ("wind_speed", "max_nulls_percent"): 1,
        ("temperature", "max_value"): 1,
        ("rule_1", "business_rule"): 1,
        ("rule_2", "business_rule"): 1,
    }

    assert (gold.source_count, gold.target_count) == (4, 2)
    report = spark.table(gold.view)
    assert rows(report, "turbine_id", "record_count", "total_power_output") == [
        ("t1", 3, 13.0), ("t2", 1, 0.0)]

    audit = spark.table(f"{database}.audit")
    assert rows(audit, "layer", "source_count", "target_count", "status") == [
        ("BRONZE", 5, 5, "SUCCESS"), ("GOLD", 4, 2, "SUCCESS"), ("SILVER", 5, 4, "SUCCESS")]

    assert rows(stored.select(F.regexp_extract("source_file", "[^/]*$", 0)).distinct()) == [
        ("a.csv",)]

    # Running it all again replaces the tables.
    again = layers.run_layers(spark, *specs(database, layer_files))
    assert [r.target_count for r in again] == [5, 4, 2]


def test_bronze_dedupe_and_case(spark, database, layer_files):
    bronze, _, _ = specs(database, layer_files)
    bronze["transform"] |= {"remove_duplicates": True, "column_case": "uppercase"}
    result = layers.run_bronze(spark, bronze)
    assert (result.source_count, result.target_count) == (5, 4)
    assert "TURBINE_ID" in spark.table(result.table).columns


def test_append_mode_adds_rows(spark, database, layer_files):
    bronze, _, _ = specs(database, layer_files)
    bronze["destination"]["write_mode"] = "append"
    layers.run_bronze(spark, bronze)
    result = layers.run_bronze(spark, bronze)
    assert result.target_count == 5
    assert spark.table(result.table).count() == 10


def test_rebalanced_silver_reports_the_same(spark, database, layer_files):
    bronze, silver, _ = specs(database, layer_files)
    layers.run_bronze(spark, bronze)
    plain = layers.run_silver(spark, silver)
    silver["destination"]["rebalance"] = True
    moved = layers.run_silver(spark, silver)
    assert rows(plain.quality) == rows(moved.quality)
    assert moved.target_count == plain.target_count


def test_empty_source(spark, database, tmp_path):
    (tmp_path / "a.csv").write_text("timestamp,turbine_id,wind_speed,power_output,temperature\n")
    bronze, silver, gold = specs(database, f"{tmp_path}/*.csv")
    bronze["source"]["schema"] = (
        "timestamp timestamp, turbine_id string, wind_speed double, "
        "power_output double, temperature double"
    )
    results = layers.run_layers(spark, bronze, silver, gold)
    assert [(r.source_count, r.target_count) for r in results] == [(0, 0)] * 3
    assert results[1].quality.where("not passed").count() == 0


def test_failure_is_recorded_raised_and_stops_the_run(spark, database, layer_files):
    bronze, silver, gold = specs(database, layer_files)
    silver["destination"]["partitions"] = ["region"]
    with pytest.raises(ValueError, match="region"):
        layers.run_layers(spark, bronze, silver, gold)
    assert rows(spark.table(f"{database}.errors"), "layer", "error_type") == [
        ("SILVER", "ValueError")]
    assert not spark.catalog.tableExists(f"{database}.gold_turbines_metrics")
    # The failed layer is on record with what it had counted.
    assert rows(spark.table(f"{database}.audit"), "layer", "status") == [
        ("BRONZE", "SUCCESS"), ("SILVER", "FAILED")]
    assert spark.table(f"{database}.audit").where("source_count IS NULL").count() == 0


def test_destination_database_is_honoured(spark, database, layer_files):
    bronze, silver, _ = specs(database, layer_files)
    layers.run_bronze(spark, bronze)
    silver["destination"]["database"] = f"{database}_silver"
    assert layers.run_silver(spark, silver).table.startswith(f"{database}_silver.")
    spark.sql(f"DROP DATABASE {database}_silver CASCADE")


def test_a_layer_is_one_write_job(spark, database, layer_files):
    """Counts and checks ride along instead of running queries of their own."""
    bronze, _, _ = specs(database, layer_files)
    bronze["source"]["schema"] = (
        "timestamp timestamp, Turbine_ID string, wind_speed double, "
        "power_output double, temperature double"
    )
    scan = layers.bronze_scan(spark, bronze)
    watch = Watch.rows(scan)
    context = spark.sparkContext
    context.setJobGroup("bronze-write", "")
    try:
        target = layers._write(spark, layers.bronze_transform(watch.df, bronze), bronze, "load_timestamp")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert (watch.row_count, target.row_count) == (5, 5)
    # The table is partitioned: adaptive execution runs the exchange that gathers its
    # rows, which is the default since then, as a job before the one that writes.
    assert len(context.statusTracker().getJobIdsForGroup("bronze-write")) == 2


def test_a_partitioned_layer_has_few_files_and_is_deduped_once(spark, database):
    df = spark.range(0, 4000, numPartitions=16).selectExpr(
        "id", "timestamp'2024-01-01' + make_interval(0, CAST(id % 20 AS INT)) AS at")
    df.union(df).write.saveAsTable(f"{database}.bronze")
    silver = {
        "source": {"database": database, "table": "bronze"},
        "transform": {
            "time_column": "at",
            "deduplication": {"enabled": True},
            "quality_checks": {"enabled": True, "rules": {"id": {"min_value": 1}}},
        },
        "destination": {"table": "silver", "partitions": ["year", "month"]},
    }
    result = layers.run_silver(spark, silver)
    assert (result.source_count, result.target_count) == (8000, 4000)
    failed = result.quality.where("NOT passed").collect()
    assert [r.violations for r in failed] == [1]
    assert len(spark.table(f"{database}.silver").inputFiles()) <= 20 + 8


@pytest.mark.parametrize("keys", [None, ["timestamp", "turbine_id"]])
def test_incremental_bronze(spark, database, tmp_path, keys):
    inbox = tmp_path / "in"
    inbox.mkdir()
    write_readings(inbox, "day1.csv", 1, 1)
    bronze, _, _ = specs(database, str(inbox))
    bronze["source"] |= {"incremental": True, "schema": CSV_SCHEMA, "options": {"header": True}}
    bronze["transform"]["time_column"] = "timestamp"
    bronze["destination"]["keys"] = keys
    assert layers.run_bronze(spark, bronze).target_count == 23
    assert layers.run_bronze(spark, bronze).target_count == 0
    # The first day comes again with the second.
    write_readings(inbox, "day2.csv", 1, 2)
    assert layers.run_bronze(spark, bronze).target_count == 47
    assert spark.table(f"{database}.bronze_turbines").count() == (47 if keys else 70)


def test_duplicate_readings_count_once_everywhere(spark, database, turbine_files):
    outputs, end = turbine.Outputs.within(database), DAY + timedelta(days=12)
    readings = spark.read.csv(turbine_files, CSV_SCHEMA, header=True)
    twice = readings.union(readings.withColumn("power_output", F.lit(90.0)))
    turbine.run_outputs(
        spark, twice, DAY, end, outputs, dedupe_source_on=[F.col("power_output").asc()])
    stored = spark.table(outputs.cleaned).groupBy("turbine_id", "date").agg(
        F.round(F.max("power_output"), 6).alias("most"))
    daily = spark.table(outputs.statistics)
    most = next(c for c in daily.columns if "max" in c and "power" in c)
    assert rows(stored, "turbine_id", "date", "most") == rows(
        daily.withColumn("most", F.round(most, 6)), "turbine_id", "date", "most")
    assert spark.table(outputs.cleaned).count() == 2 * 12 * 24


# --- incremental ingest ----------------------------------------------------

INGEST_SCHEMA = "id int, v string, day date"


def deliver(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("id,v,day\n" + "\n".join(lines) + "\n")


def test_ingest_upserts_only_new_files(spark, database, tmp_path):
    inbox, name = tmp_path / "in", f"{database}.t"
    seen = []

    def run():
        ingest_new_files(
            spark, str(inbox), name, INGEST_SCHEMA, options={"header": True},
            keys=["id", "day"], partition_by=["day"], dedupe_source_on=[F.col("v").desc()],
            transform=lambda df: (seen.append(df.count()), df)[1],
        )
        return rows(spark.table(name), "id", "v")

    deliver(inbox, "1.csv", ["1,a,2024-01-01", "2,b,2024-01-01"])
    assert run() == [(1, "a"), (2, "b")]
    deliver(inbox, "2.csv", ["2,B,2024-01-01", "3,c,2024-01-02", "3,d,2024-01-02"])
    assert run() == [(1, "a"), (2, "B"), (3, "d")]
    assert run() == [(1, "a"), (2, "B"), (3, "d")]
    assert seen == [2, 3]


def ids(spark, name):
    return [r[0] for r in rows(spark.table(name), "id")]


def ingest(spark, inbox, name, **more):
    return ingest_new_files(
        spark, str(inbox), name, INGEST_SCHEMA, options={"header": True}, **more
    )


def test_ingest_without_keys_appends_each_file_once(spark, database, tmp_path):
    inbox, name = tmp_path / "in", f"{database}.t"
    deliver(inbox, "1.csv", ["1,a,2024-01-01"])
    assert ingest(spark, inbox, name).files == 1
    deliver(inbox, "2.csv", ["2,b,2024-01-01"])
    assert ingest(spark, inbox, name, max_files_per_batch=1).source_count == 1
    assert ids(spark, name) == [1, 2]
    assert ingest(spark, inbox, name).files == 0
    # Without the ledger it cannot be told what the table holds.
    spark.sql(f"DROP TABLE {ledger_of(name)}")
    with pytest.raises(ValueError, match="ledger"):
        ingest(spark, inbox, name)
    assert ids(spark, name) == [1, 2]


def test_ingest_of_two_sources(spark, database, tmp_path):
    name = f"{database}.t"
    for source, lines in (("a", ["1,a,2024-01-01", "2,a,2024-01-01"]), ("b", ["3,b,2024-01-01"])):
        deliver(tmp_path / source, "1.csv", lines)
        for _ in range(2):
            ingest(spark, tmp_path / source, name)
    assert ids(spark, name) == [1, 2, 3]


@pytest.mark.parametrize("keys", [None, ["id"]])
def test_ingest_of_changed_and_old_files(spark, database, tmp_path, keys):
    inbox, name = tmp_path / "in", f"{database}.t"
    deliver(inbox, "1.csv", ["1,a,2024-01-01", "2,a,2024-01-01"])
    deliver(inbox, "2.csv", ["7,a,2024-01-01"])
    ingest(spark, inbox, name, keys=keys)
    deliver(inbox, "1.csv", ["1,b,2024-01-01", "2,b,2024-01-01", "3,b,2024-01-01"])
    deliver(inbox, "old.csv", ["4,o,2024-01-01"])
    os.utime(inbox / "old.csv", (1_600_000_000, 1_600_000_000))
    done = ingest(spark, inbox, name, keys=keys)
    assert (done.files, done.source_count, done.target_count) == (2, 4, 4)
    assert rows(spark.table(name), "id", "v") == [(1, "b"), (2, "b"), (3, "b"), (4, "o"), (7, "a")]
    if not keys:
        # A batch whose files have all changed ends up empty.
        deliver(inbox, "1.csv", ["9,c,2024-01-01"])
        deliver(inbox, "old.csv", ["8,c,2024-01-01", "5,c,2024-01-01"])
        ingest(spark, inbox, name)
        assert ids(spark, name) == [5, 7, 8, 9]


def test_newest_file_wins_and_null_keys_stay(spark, database, tmp_path):
    inbox, name = tmp_path / "in", f"{database}.t"
    deliver(inbox, "z.csv", ["1,old,2024-01-01", ",x,2024-01-01"])
    deliver(inbox, "a.csv", ["1,new,2024-01-01", ",x,2024-01-01"])
    os.utime(inbox / "z.csv", (1_600_000_000, 1_600_000_000))
    ingest(spark, inbox, name, keys=["id"])
    assert rows(spark.table(name), "id", "v") == sorted([(1, "new"), (None, "x"), (None, "x")], key=repr)


def test_a_run_that_broke_off_is_made_good(spark, database, tmp_path, monkeypatch):
    inbox, name = tmp_path / "in", f"{database}.t"
    deliver(inbox, "1.csv", ["1,a,2024-01-01"])
    ingest(spark, inbox, name)
    deliver(inbox, "2.csv", ["2,b,2024-01-01"])
    enter = ingest_module._Ledger.enter

    def broken(self, files, batch, done):
        if done:
            raise OSError("lost")
        enter(self, files, batch, done)

    monkeypatch.setattr(ingest_module._Ledger, "enter", broken)
    with pytest.raises(OSError, match="lost"):
        ingest(spark, inbox, name)
    monkeypatch.undo()
    deliver(inbox, "3.csv", ["3,c,2024-01-01"])
    ingest(spark, inbox, name)
    assert ids(spark, name) == [1, 2, 3]


def test_ingest_checks_headers(spark, database, tmp_path):
    (tmp_path / "1.csv").write_text("v,id,day\n10,1,2024-01-01\n")
    with pytest.raises(Exception, match="(?i)header"):
        ingest(spark, tmp_path, f"{database}.t")


def test_ingest_keeps_columns_that_appear_later(spark, database, tmp_path):
    inbox, name = tmp_path / "in", f"{database}.t"
    for file, schema, line in (
        ("1.csv", "id int, v string", "1,a"), ("2.csv", "id int, v string, w int", "2,b,5")
    ):
        inbox.mkdir(exist_ok=True)
        (inbox / file).write_text(line + "\n")
        ingest_new_files(spark, str(inbox), name, schema)
    assert rows(spark.table(name), "id", "v", "w") == [(1, "a", None), (2, "b", 5)]

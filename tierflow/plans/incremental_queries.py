"""Queries over what jobs keep from run to run, with SQL for the state they must reach."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions import protect
from tierflow.operators import moments
from tierflow.operators import quality as qual
from tierflow.operators import timeseries as series
from tierflow.plans import layers, reports, turbine
from tierflow.plans.queries import (
    ANOMALIES_SELECT,
    CLEANED_SELECT,
    END,
    LINE_BUSINESS_RULES,
    LINE_REPORT_SQL,
    LINE_RULES,
    PROFILE_SELECT,
    READINGS_SQL,
    START,
    deliver,
    layer_specs,
    query,
    readings,
    rounded,
    rounded_sql,
    scratch_database,
    series_sql,
    table,
)
from tierflow.plans.specs import turbine_specs
from tierflow.sinks.snapshots import publish_snapshot
from tierflow.sinks.tables import save_table
from tierflow.sinks.tokens import TokenMapping
from tierflow.sinks.upsert import upsert
from tierflow.sources.files import scan_files, scan_table
from tierflow.sources.zones import ZoneMap
from tierflow.staging import new_path, stage
from tierflow.streaming.ingest import ingest_new_files

READING = (
    "timestamp timestamp_ntz, turbine_id string, wind_speed double, "
    "wind_direction double, power_output double"
)


def _csv_by_time(spark: SparkSession, df: DataFrame, files: int = 30) -> str:
    """Readings as CSV files, each of a stretch of time."""
    path = new_path(spark, "csv-by-time")
    dealt = df.repartitionByRange(files, "timestamp")
    dealt.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path, header=True)
    return path


@query(
    "window_load_pruned",
    """SELECT ts AS timestamp, user_id AS turbine_id, value AS wind_speed, true AS pruned
    FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-09 00:00:00'""",
)
def window_load_pruned(spark, folder):
    """The second window of a day finds the files it needs in the zone map."""
    events = table(spark, folder, "events").select(
        F.col("ts").alias("timestamp"), F.col("user_id").alias("turbine_id"), F.col("value").alias("wind_speed")
    )
    path = _csv_by_time(spark, events)
    zones = ZoneMap(spark, f"{scratch_database(spark)}.zones")
    schema = "timestamp timestamp_ntz, turbine_id long, wind_speed double"
    with zones.window(path, START, "2024-01-02", schema):
        pass
    with zones.window(path, "2024-01-08", "2024-01-09", schema) as found:
        pruned = F.lit(found.skipped > found.opened)
        return stage(found.rows.withColumn("pruned", pruned), "window")[0]


@query("ingest_duplicates_across_runs", "SELECT DISTINCT user_id, event_type FROM events")
def ingest_duplicates_across_runs(spark, folder):
    """Four deliveries, the last of which takes rows out of the first file."""
    database, path = scratch_database(spark), new_path(spark, "deliveries")
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    bronze = {
        "source": {
            "path": f"{path}/*", "format": "parquet", "incremental": True,
            "schema": "user_id long, event_type string", "max_files_per_batch": 1,
        },
        "transform": {"remove_duplicates": True, "add_metadata_columns": ["load_timestamp"]},
        "destination": {"database": database, "table": "pairs"},
        "audit": {"audit_table": f"{database}.audit", "error_table": f"{database}.errors"},
    }
    for name, condition in (
        ("first", "event_id % 2 = 0"), ("second", "event_id % 3 <> 1"), ("third", "true"),
        ("first", "event_id % 5 = 0"),
    ):
        deliver(events.where(condition).drop("event_id"), path, name, files=1)
        layers.run_bronze(spark, bronze)
    return scan_table(spark, f"{database}.pairs").select("user_id", "event_type")


@query(
    "ingest_in_batches",
    "SELECT event_id, event_type, true AS several FROM events",
)
def ingest_in_batches(spark, folder):
    """Batches of bounded size, cut from a list of files that is stored."""
    database, path = scratch_database(spark), new_path(spark, "deliveries")
    events = table(spark, folder, "events").select("event_id", "event_type")
    events.repartition(6, "event_id").write.json(path)
    sizes = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    name = f"{database}.events"
    ingest_new_files(spark, path, name, events.schema, "json", max_bytes_per_batch=max(1, sizes // 3))
    stored = scan_table(spark, name)
    several = stored.select("ingest_batch").distinct().limit(2).count() > 1
    return stored.select("event_id", "event_type", F.lit(several).alias("several"))


_LATER = {"TIMESTAMP '2024-01-01 00:00:00'": "TIMESTAMP '2024-01-02 00:00:00'"}


@query(
    "profile_incremental",
    series_sql(READINGS_SQL, PROFILE_SELECT).replace(*next(iter(_LATER.items()))),
)
def profile_incremental(spark, folder):
    """Moments of 29 days, then of one more; a profile without the first day."""
    stored, _ = stage(readings(spark, folder), "readings")
    placed = series.on_grid(stored, START, END)
    name = f"{scratch_database(spark)}.moments"
    days = [date(2024, 1, d) for d in range(1, 31)]
    moments.store_moments(spark, placed.where(F.to_date("timestamp") < "2024-01-30"), name, days[:-1])
    moments.store_moments(spark, placed.where(F.to_date("timestamp") == "2024-01-30"), name, days[-1:])
    return rounded(moments.stored_profile(spark, name, days[1], days[-1]))


def _daily_job(spark: SparkSession, folder: str) -> turbine.Outputs:
    path = _csv_by_time(spark, readings(spark, folder))
    outputs = turbine.Outputs.within(scratch_database(spark))
    turbine.refresh_moments(spark, path, date(2024, 1, 1), date(2024, 1, 28), READING, outputs)
    for day in (29, 30):
        turbine.run_turbines_daily(spark, path, date(2024, 1, day), 30, READING, outputs)
    return outputs


@query(
    "turbine_daily_cleaned",
    series_sql(READINGS_SQL, CLEANED_SELECT) + " WHERE timestamp >= TIMESTAMP '2024-01-30 00:00:00'",
)
def turbine_daily_cleaned(spark, folder):
    """The last day of the window, as a run over all of it would leave it."""
    cleaned = spark.table(_daily_job(spark, folder).cleaned)
    return rounded(cleaned.where("date = date'2024-01-30'").drop("date"))


@query(
    "turbine_daily_anomalies",
    series_sql(READINGS_SQL, ANOMALIES_SELECT) + " WHERE timestamp >= TIMESTAMP '2024-01-30 00:00:00'",
)
def turbine_daily_anomalies(spark, folder):
    anomalies = spark.table(_daily_job(spark, folder).anomalies)
    return rounded(anomalies.where("date = date'2024-01-30'").drop("date"))


@query("turbine_run_deduped", series_sql(READINGS_SQL, CLEANED_SELECT))
def turbine_run_deduped(spark, folder):
    """Every reading comes twice; the one with the lower output counts."""
    once = readings(spark, folder)
    path = new_path(spark, "turbine-csv")
    once.union(once.withColumn("power_output", F.col("power_output") + 1)).write.csv(path, header=True)
    outputs = turbine.Outputs.within(scratch_database(spark))
    turbine.run_turbines(
        spark, path, START, END, outputs, schema=READING, dedupe_source_on=[F.col("power_output").asc()]
    )
    return rounded(spark.table(outputs.cleaned).drop("date"))


def _reported(grain: str, unit: str) -> None:
    @query(
        f"reports_{grain}",
        f"""SELECT event_type, date_trunc('{unit}', ts) AS agg_date,
        {rounded_sql("sum(value)", "total_value")}, {rounded_sql("avg(value)", "avg_value")},
        {rounded_sql("min(value)", "least")}, {rounded_sql("max(value)", "most")},
        count(*) AS record_count, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2""",
    )
    def run(spark, folder):
        """Two ingests of which the second also brings rows for days of the first."""
        database = scratch_database(spark)
        events = table(spark, folder, "events").select("event_id", "event_type", "user_id", "value", "ts")
        kept = reports.Reports(
            f"{database}.events", f"{database}.report", "ts", ("event_type",),
            {
                "total_value": "sum(value)", "avg_value": "avg(value)", "least": "min(value)",
                "most": "max(value)", "record_count": "count(*)", "users": "count(distinct user_id)",
            },
            grains=(grain,),
        )
        late = "event_id % 7 = 0 OR ts >= timestamp_ntz'2024-01-20'"
        for condition in (f"NOT ({late})", late):
            delivery = events.where(condition)
            save_table(delivery, kept.source, "append")
            reports.refresh_reports(spark, kept, reports.changed_days(delivery, "ts"))
        result = scan_table(spark, kept.table(grain)).drop(reports.REPORT_DAY)
        return rounded(result)


for _grain, _unit in (("hourly", "hour"), ("daily", "day"), ("weekly", "week"), ("monthly", "month")):
    _reported(_grain, _unit)


@query(
    "snapshot_readers",
    """SELECT 'before' AS state, o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT 'after', o_orderkey, CASE WHEN o_orderkey % 3 = 0
    THEN round(o_totalprice + 1, 4) ELSE o_totalprice END FROM orders
    WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0""",
)
def snapshot_readers(spark, folder):
    """A read that was planned before an upsert sees the old table, whole."""
    name = f"{scratch_database(spark)}.orders"
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    upsert(spark, orders.where("o_orderkey % 2 = 0"), name, ["o_orderkey"], keys_are_unique=True)
    before = scan_table(spark, name)
    changed = orders.where("o_orderkey % 3 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    upsert(spark, changed, name, ["o_orderkey"], keys_are_unique=True)
    states = before.select(F.lit("before").alias("state"), "*").union(
        scan_table(spark, name).select(F.lit("after").alias("state"), "*")
    )
    return rounded(states)


@query("snapshot_overwrite", "SELECT c_custkey, upper(c_name) AS c_name FROM customer")
def snapshot_overwrite(spark, folder):
    """A table is made from itself, and published at once."""
    name = f"{scratch_database(spark)}.customer"
    save_table(table(spark, folder, "customer").select("c_custkey", "c_name"), name)
    publish_snapshot(scan_table(spark, name).withColumn("c_name", F.upper("c_name")), name)
    return scan_table(spark, name)


@query(
    "token_mapping_lasting",
    "SELECT DISTINCT user_id, sha256(CAST(user_id AS VARCHAR) || CASE WHEN user_id IN "
    "(SELECT user_id FROM events WHERE event_id % 2 = 0) THEN 's' ELSE 't' END) AS user_id_token "
    "FROM events",
)
def token_mapping_lasting(spark, folder):
    """The salt changes between two runs; values of the first keep their tokens."""
    name = f"{scratch_database(spark)}.tokens"
    events = table(spark, folder, "events")
    TokenMapping(spark, name, "user_id", "s").extend(events.where("event_id % 2 = 0"))
    TokenMapping(spark, name, "user_id", "t").extend(events)
    return scan_table(spark, name)


@query("token_restored", "SELECT event_id, user_id, true AS hidden FROM events")
def token_restored(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id")
    mapping = TokenMapping(spark, f"{scratch_database(spark)}.tokens", "user_id", "s")
    mapping.extend(events)
    hidden = mapping.tokenize(events)
    shown = F.lit("user_id" not in hidden.columns)
    return mapping.restore(hidden).select("event_id", "user_id", shown.alias("hidden"))


@query("expectations_report", " UNION ALL ".join(LINE_REPORT_SQL))
def expectations_report(spark, folder):
    """The report on rules, taken while the flagged table is saved."""
    checked = qual.validate_expectations(table(spark, folder, "lineitem"), LINE_RULES)
    save_table(checked.flagged, f"{scratch_database(spark)}.lines")
    return rounded(checked.report())


@query(
    "expectations_business_rules",
    """SELECT 'rule_' || i AS column_name, broken AS violations, broken = 0 AS passed FROM (
    SELECT unnest([1, 2, 3]) AS i, unnest([
      count(*) FILTER (l_quantity > 30 AND NOT l_discount > 0),
      count(*) FILTER (NOT l_tax BETWEEN 0 AND 0.05),
      count(*) FILTER (l_quantity > 2 AND NOT l_extendedprice > 1000)]) AS broken FROM lineitem)""",
)
def expectations_business_rules(spark, folder):
    lines = table(spark, folder, "lineitem")
    checked = qual.validate_expectations(lines, {}, LINE_BUSINESS_RULES)
    save_table(checked.flagged.select("l_orderkey", "quality_flag"), f"{scratch_database(spark)}.lines")
    return checked.report().where("rule = 'business_rule'").select("column_name", "violations", "passed")


@query(
    "layered_csv",
    f"""SELECT lower(trim(turbine_id)) AS turbine_id,
    {rounded_sql("sum(power_output)", "total_power_output")},
    {rounded_sql("avg(power_output)", "avg_power_output")},
    {rounded_sql("max(power_output)", "max_power_output")},
    {rounded_sql("min(power_output)", "min_power_output")},
    {rounded_sql("avg(wind_speed)", "avg_wind_speed")},
    {rounded_sql("avg(wind_direction)", "avg_temperature")}, count(*) AS record_count
    FROM ({READINGS_SQL}) GROUP BY 1""",
)
def layered_csv(spark, folder):
    """CSV through all layers by the turbine specifications; all rows are of one load."""
    path = new_path(spark, "layers-csv")
    readings(spark, folder).withColumnRenamed("wind_direction", "temperature").write.csv(path, header=True)
    database = scratch_database(spark)
    audit = {"audit_table": f"{database}.audit", "error_table": f"{database}.errors"}
    specs = [{**spec, "audit": audit} for spec in turbine_specs(path, database)]
    _, _, gold = layers.run_layers(spark, *specs)
    dropped = ["agg_date", "report_generated_at", "report_version", "year", "month"]
    return rounded(scan_table(spark, gold.view).drop(*dropped))


@query(
    "layered_resume",
    """SELECT layer, status, count(*) AS runs, max(n) AS source_count FROM (
    SELECT 'BRONZE' AS layer, 'SUCCESS' AS status, (SELECT count(*) FROM events) AS n
    UNION ALL SELECT 'SILVER', 'SUCCESS', (SELECT count(*) FROM events)
    UNION ALL SELECT 'GOLD', 'FAILED', (SELECT count(*) FROM events)
    UNION ALL SELECT 'GOLD', 'SUCCESS', (SELECT count(*) FROM events)) GROUP BY 1, 2""",
)
def layered_resume(spark, folder):
    """Gold fails, is mended, and runs again; bronze and silver are not run twice."""
    database = scratch_database(spark)
    bronze, silver, gold = layer_specs(database, folder)
    broken = {**gold, "transform": {**gold["transform"], "dimensions": ["no_such_column"]}}
    try:
        layers.run_layers(spark, bronze, silver, broken, job_id="night")
    except ValueError:
        pass
    layers.run_layers(spark, bronze, silver, gold, job_id="night")
    runs = scan_table(spark, f"{database}.pipeline_audit").groupBy("layer", "status")
    return runs.agg(F.count("*").alias("runs"), F.max("source_count").alias("source_count"))


@query(
    "unknown_format",
    """SELECT r_regionkey, 'ValueError' AS error FROM region""",
)
def unknown_format(spark, folder):
    """A source of a format that is not accepted is an error before anything is read."""
    try:
        scan_files(spark, f"{folder}/region.parquet", "xml")
        error = None
    except ValueError as raised:
        error = type(raised).__name__
    return table(spark, folder, "region").select("r_regionkey", F.lit(error).alias("error"))


# Signs that may stand before the @ of an address, and what may follow it.
_LOCAL_SQL = r"""[^\x00-\x20@<>(),;:"\[\]\\]"""
_ADDRESS_SQL = rf"{_LOCAL_SQL}+@\[?[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}-]*(\.[\p{{L}}\p{{N}}-]+)*"


@query(
    "mask_email_leaks",
    f"""SELECT doc_id, CAST(0 AS BIGINT) AS leaks,
    CAST(len(regexp_extract_all(text, '{_ADDRESS_SQL}')) AS BIGINT) AS masks,
    md5(regexp_replace(text, '{_ADDRESS_SQL}', '', 'g')) AS rest FROM documents
    WHERE text IS NOT NULL""",
)
def mask_email_leaks(spark, folder):
    """What a reader of masked texts finds: no address, a mask for each, the rest as it was."""
    docs = table(spark, folder, "documents").select("doc_id", "text").where("text IS NOT NULL")
    masked = protect.mask_email(docs, "text")
    local, host = r"""[^\x00-\x20@<>(),;:"\[\]\\]""", r"[\p{L}\p{N}-]"
    form = rf"{local}\*\*\*@\[?[\p{{L}}\p{{N}}]\*\*\*(\.{host}+)*"
    clear = rf"""[^\x00-\x20@<>(),;:"\[\]\\*]@\[?[\p{{L}}\p{{N}}]"""
    return masked.select(
        "doc_id",
        F.regexp_count("text", F.lit(clear)).cast("long").alias("leaks"),
        F.regexp_count("text", F.lit(form)).cast("long").alias("masks"),
        F.md5(F.regexp_replace("text", form, "")).alias("rest"),
    )

"""The operators and jobs as named queries over a folder of Parquet tables.

Each query comes with SQL that says the same, where SQL can say it. Doubles
that come out of arithmetic are rounded to four places on both sides. Means of
amounts in cents do fall on ties such as 0.00005, which the last bit of a double
would send either way, so both sides add a small amount first.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions import protect
from tierflow.operators import columns as cols
from tierflow.operators import metrics as met
from tierflow.operators import quality as qual
from tierflow.operators import timeseries as series
from tierflow.operators.dedupe import duplicate_counts, remove_duplicates
from tierflow.plans import layers, turbine
from tierflow.sinks.snapshots import files_below
from tierflow.sinks.tables import derive_partitions, publish_view, save_table
from tierflow.sinks.upsert import upsert
from tierflow.sources.files import in_window, load_window, scan_files, scan_table
from tierflow.staging import children, move, new_path, release, stage
from tierflow.streaming.ingest import ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

START, END = "2024-01-01", "2024-01-31"
NUDGE = 0.0000001


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to four places."""
    return df.select(
        *[
            F.round(F.col(c) + NUDGE, 4).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )


def scratch_database(spark: SparkSession) -> str:
    """A database of its own for a query that writes tables.

    Its files lie below the work folder and go when the driver ends.
    """
    name = f"scratch_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_path(spark, name)}'")
    return name


def rounded_sql(expression: str, name: str) -> str:
    return f"round({expression} + 0.0000001::DOUBLE, 4) AS {name}"


# --- readings derived from events ------------------------------------------


def _readings(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    """Events averaged and summed per hour and entity: one reading per slot."""
    return (
        table(spark, folder, "events")
        .groupBy(
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp"),
            F.col(entity).alias("turbine_id"),
        )
        .agg(
            F.avg("value").alias("wind_speed"),
            F.avg(F.get_json_object("props", "$.k").cast("double")).alias("wind_direction"),
            F.sum("value").alias("power_output"),
        )
    )


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """One series per event type."""
    return _readings(spark, folder, "event_type")


def user_readings(spark: SparkSession, folder: str) -> DataFrame:
    """One series per user: many entities with few readings."""
    return _readings(spark, folder, "user_id")


def stored(df: DataFrame) -> DataFrame:
    """Readings that come from an aggregation, for operators that read them several times."""
    return stage(df, "readings")[0]


def event_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Every event is a reading: many copies per slot, and a few huge series."""
    return table(spark, folder, "events").select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp"),
        F.col("event_type").alias("turbine_id"),
        F.col("value").alias("wind_speed"),
        F.get_json_object("props", "$.k").cast("double").alias("wind_direction"),
        (F.col("value") * 2).alias("power_output"),
    )


K_SQL = """CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS DOUBLE)"""


def _readings_sql(entity: str) -> str:
    return f"""SELECT date_trunc('hour', ts) AS timestamp, {entity} AS turbine_id,
        avg(value) AS wind_speed, avg({K_SQL}) AS wind_direction, sum(value) AS power_output
        FROM events GROUP BY 1, 2"""


READINGS_SQL = _readings_sql("event_type")
USER_READINGS_SQL = _readings_sql("user_id")
EVENT_READINGS_SQL = f"""SELECT date_trunc('hour', ts) AS timestamp, event_type AS turbine_id,
        value AS wind_speed, {K_SQL} AS wind_direction, value * 2 AS power_output FROM events"""


def series_sql(readings_sql: str, select: str) -> str:
    """The whole chain, written as the textbook grid join, then ``select``."""
    return f"""WITH readings AS ({readings_sql}),
    grid AS (SELECT t.timestamp, e.turbine_id, CAST(hour(t.timestamp) AS INTEGER) AS hour
        FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00',
            TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS timestamp) t
        CROSS JOIN (SELECT DISTINCT turbine_id FROM readings) e),
    completed AS (SELECT g.timestamp, g.turbine_id, g.hour, r.wind_speed, r.wind_direction,
        r.power_output FROM grid g LEFT JOIN readings r
        ON g.timestamp = r.timestamp AND g.turbine_id = r.turbine_id),
    profile AS (SELECT turbine_id, hour, avg(wind_speed) AS wind_speed_mean,
        avg(wind_direction) AS wind_direction_mean, avg(power_output) AS power_output_mean,
        stddev_samp(wind_speed) AS wind_speed_stddev,
        stddev_samp(wind_direction) AS wind_direction_stddev,
        stddev_samp(power_output) AS power_output_stddev
        FROM completed GROUP BY 1, 2),
    imputed AS (SELECT c.timestamp, c.turbine_id, c.hour,
        coalesce(wind_speed, wind_speed_mean) AS wind_speed,
        coalesce(wind_direction, wind_direction_mean) AS wind_direction,
        coalesce(power_output, power_output_mean) AS power_output,
        wind_speed_mean, wind_direction_mean, power_output_mean,
        wind_speed_stddev, wind_direction_stddev, power_output_stddev
        FROM completed c LEFT JOIN profile p ON c.turbine_id = p.turbine_id AND c.hour = p.hour),
    scored AS (SELECT *,
        abs((wind_speed - wind_speed_mean) / nullif(wind_speed_stddev, 0)) AS wind_speed_zscore,
        abs((wind_direction - wind_direction_mean) / nullif(wind_direction_stddev, 0))
            AS wind_direction_zscore,
        abs((power_output - power_output_mean) / nullif(power_output_stddev, 0))
            AS power_output_zscore FROM imputed),
    cleaned AS (SELECT timestamp, turbine_id,
        CASE WHEN wind_speed_zscore > 3 THEN wind_speed_mean ELSE wind_speed END AS wind_speed,
        CASE WHEN wind_direction_zscore > 3 THEN wind_direction_mean ELSE wind_direction END
            AS wind_direction,
        CASE WHEN power_output_zscore > 3 THEN power_output_mean ELSE power_output END
            AS power_output FROM scored),
    anomalies AS (SELECT timestamp, turbine_id, wind_speed, wind_direction, power_output
        FROM scored WHERE power_output_zscore > 2),
    daily AS (SELECT CAST(timestamp AS DATE) AS date, turbine_id,
        min(power_output) AS power_output_min, max(power_output) AS power_output_max,
        avg(power_output) AS power_output_avg FROM cleaned GROUP BY 1, 2)
    {select}"""


def _round_sql(names: str) -> str:
    return ", ".join(rounded_sql(n.strip(), n.strip()) for n in names.split(","))


MEASURES_SQL = _round_sql("wind_speed, wind_direction, power_output")
PROFILE_SQL = _round_sql(
    "wind_speed_mean, wind_direction_mean, power_output_mean, "
    "wind_speed_stddev, wind_direction_stddev, power_output_stddev"
)
SCORES_SQL = _round_sql("wind_speed_zscore, wind_direction_zscore, power_output_zscore")
STATS_SQL = _round_sql("power_output_min, power_output_max, power_output_avg")

GRID_SELECT = "SELECT timestamp, hour, turbine_id FROM grid"
GAPS_SELECT = (
    "SELECT timestamp, turbine_id, hour FROM completed WHERE wind_speed IS NULL"
)
PROFILE_SELECT = f"SELECT turbine_id, hour, {PROFILE_SQL} FROM profile"
IMPUTED_SELECT = (
    f"SELECT turbine_id, hour, timestamp, {MEASURES_SQL}, {PROFILE_SQL} FROM imputed"
)
SCORED_SELECT = (
    f"SELECT turbine_id, hour, timestamp, {MEASURES_SQL}, {PROFILE_SQL}, {SCORES_SQL} FROM scored"
)
CLEANED_SELECT = f"SELECT timestamp, turbine_id, {MEASURES_SQL} FROM cleaned"
ANOMALIES_SELECT = f"SELECT timestamp, turbine_id, {MEASURES_SQL} FROM anomalies"
DAILY_SELECT = f"SELECT date, turbine_id, {STATS_SQL} FROM daily"


# --- time series -----------------------------------------------------------


@query(
    "window_load",
    """SELECT * FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-22 00:00:00'""",
)
def window_load(spark, folder):
    events = table(spark, folder, "events")
    return events.where(in_window(events, "ts", "2024-01-08", "2024-01-22"))


@query(
    "window_load_csv",
    """SELECT ts AS timestamp, user_id AS turbine_id, value AS wind_speed FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-22 00:00:00'""",
)
def window_load_csv(spark, folder):
    path = new_path(spark, "readings-csv")
    table(spark, folder, "events").select(
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("turbine_id"),
        F.col("value").alias("wind_speed"),
    ).write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path, header=True)
    return load_window(
        spark, path, "2024-01-08", "2024-01-22",
        schema="timestamp timestamp_ntz, turbine_id long, wind_speed double",
    )


@query("hourly_grid", series_sql(READINGS_SQL, GRID_SELECT))
def hourly_grid(spark, folder):
    return series.entity_grid(readings(spark, folder), START, END)


@query("user_grid", series_sql(USER_READINGS_SQL, GRID_SELECT))
def user_grid(spark, folder):
    return series.entity_grid(user_readings(spark, folder), START, END)


@query("gap_rows", series_sql(READINGS_SQL, GAPS_SELECT))
def gap_rows(spark, folder):
    return series.missing_slots(readings(spark, folder), START, END)


@query("user_gap_rows", series_sql(USER_READINGS_SQL, GAPS_SELECT))
def user_gap_rows(spark, folder):
    return series.missing_slots(user_readings(spark, folder), START, END)


@query(
    "completed_grid",
    series_sql(READINGS_SQL, f"SELECT timestamp, turbine_id, hour, {MEASURES_SQL} FROM completed"),
)
def completed_grid(spark, folder):
    return rounded(series.complete_grid(readings(spark, folder), START, END))


@query("entities", "SELECT DISTINCT user_id AS turbine_id FROM events")
def entities(spark, folder):
    events = table(spark, folder, "events").withColumnRenamed("user_id", "turbine_id")
    return series.distinct_entities(events)


@query("hourly_profile", series_sql(READINGS_SQL, PROFILE_SELECT))
def hourly_profile(spark, folder):
    completed = series.complete_grid(readings(spark, folder), START, END)
    return rounded(series.hourly_profile(completed))


@query("imputed", series_sql(READINGS_SQL, IMPUTED_SELECT))
def imputed(spark, folder):
    return rounded(series.impute(stored(readings(spark, folder)), START, END))


@query("user_imputed", series_sql(USER_READINGS_SQL, IMPUTED_SELECT))
def user_imputed(spark, folder):
    return rounded(series.impute(stored(user_readings(spark, folder)), START, END))


@query("zscores", series_sql(READINGS_SQL, SCORED_SELECT))
def zscores(spark, folder):
    return rounded(series.process(stored(readings(spark, folder)), START, END))


@query("event_zscores", series_sql(EVENT_READINGS_SQL, SCORED_SELECT))
def event_zscores(spark, folder):
    return rounded(series.process(event_readings(spark, folder), START, END))


@query("cleaned", series_sql(READINGS_SQL, CLEANED_SELECT))
def cleaned(spark, folder):
    scored = series.process(stored(readings(spark, folder)), START, END)
    return rounded(series.replace_outliers(scored))


@query("event_cleaned", series_sql(EVENT_READINGS_SQL, CLEANED_SELECT))
def event_cleaned(spark, folder):
    scored = series.process(event_readings(spark, folder), START, END)
    return rounded(series.replace_outliers(scored))


@query("anomalies", series_sql(READINGS_SQL, ANOMALIES_SELECT))
def anomalies(spark, folder):
    scored = series.process(stored(readings(spark, folder)), START, END)
    return rounded(series.find_anomalies(scored))


@query("event_anomalies", series_sql(EVENT_READINGS_SQL, ANOMALIES_SELECT))
def event_anomalies(spark, folder):
    scored = series.process(event_readings(spark, folder), START, END)
    return rounded(series.find_anomalies(scored))


@query("daily_statistics", series_sql(READINGS_SQL, DAILY_SELECT))
def daily_statistics(spark, folder):
    scored = series.process(stored(readings(spark, folder)), START, END)
    return rounded(series.daily_statistics(series.replace_outliers(scored)))


@query("user_daily_statistics", series_sql(USER_READINGS_SQL, DAILY_SELECT))
def user_daily_statistics(spark, folder):
    scored = series.process(stored(user_readings(spark, folder)), START, END)
    return rounded(series.daily_statistics(series.replace_outliers(scored)))


@query("event_daily_statistics", series_sql(EVENT_READINGS_SQL, DAILY_SELECT))
def event_daily_statistics(spark, folder):
    scored = series.process(event_readings(spark, folder), START, END)
    return rounded(series.daily_statistics(series.replace_outliers(scored)))


def _turbine_tables(spark: SparkSession, folder: str) -> turbine.Outputs:
    """Run the turbine job on CSV readings: first half, then the whole window."""
    path = new_path(spark, "turbine-csv")
    readings(spark, folder).write.csv(path, header=True)
    schema = (
        "timestamp timestamp_ntz, turbine_id string, wind_speed double, "
        "wind_direction double, power_output double"
    )
    outputs = turbine.Outputs.within(scratch_database(spark))
    turbine.run_turbines(spark, path, START, "2024-01-16", outputs, schema=schema)
    turbine.run_turbines(spark, path, START, END, outputs, schema=schema)
    return outputs


@query("turbine_run_cleaned", series_sql(READINGS_SQL, CLEANED_SELECT))
def turbine_run_cleaned(spark, folder):
    return rounded(spark.table(_turbine_tables(spark, folder).cleaned).drop("date"))


@query("turbine_run_statistics", series_sql(READINGS_SQL, DAILY_SELECT))
def turbine_run_statistics(spark, folder):
    return rounded(spark.table(_turbine_tables(spark, folder).statistics))


# An anomaly of the first, shorter run that the second no longer finds stays
# stored: an upsert deletes nothing. So the table is the one run's result plus
# what only the earlier run found.
_FIRST_RUN = series_sql(READINGS_SQL, "SELECT * FROM anomalies").replace(
    "2024-01-30 23:00:00", "2024-01-15 23:00:00"
).replace("FROM events", "FROM events WHERE ts < TIMESTAMP '2024-01-16 01:00:00'")
_SECOND_RUN = series_sql(READINGS_SQL, "SELECT * FROM anomalies")


@query(
    "turbine_run_anomalies",
    f"""WITH first_run AS ({_FIRST_RUN}), second_run AS ({_SECOND_RUN})
    SELECT timestamp, turbine_id, {MEASURES_SQL} FROM (
        SELECT * FROM second_run UNION ALL
        SELECT * FROM first_run f WHERE NOT EXISTS (SELECT 1 FROM second_run s
            WHERE s.timestamp = f.timestamp AND s.turbine_id = f.turbine_id))""",
)
def turbine_run_anomalies(spark, folder):
    return rounded(spark.table(_turbine_tables(spark, folder).anomalies).drop("date"))


# --- columns ---------------------------------------------------------------


@query(
    "metadata_columns",
    """SELECT o_orderkey, 'BRONZE' AS layer_name, true AS run_id_ok, true AS date_ok,
    true AS processed_ok, true AS source_ok FROM orders""",
)
def metadata_columns(spark, folder):
    names = [
        "load_timestamp", "load_date", "load_run_id", "source_file", "layer_name",
        "processed_at", "record_id",
    ]
    df = cols.add_metadata_columns(table(spark, folder, "orders"), names, "BRONZE")
    stamp = F.col("load_timestamp")
    return df.select(
        "o_orderkey",
        "layer_name",
        (F.col("load_run_id") == F.concat(F.lit("run_"), stamp.cast("string"))).alias("run_id_ok"),
        (F.col("load_date") == F.to_date(stamp)).alias("date_ok"),
        (F.col("processed_at") == stamp).alias("processed_ok"),
        F.col("source_file").endswith("orders.parquet").alias("source_ok"),
    )


@query("record_ids", "SELECT count(*) AS n_rows, count(*) AS n_ids FROM lineitem")
def record_ids(spark, folder):
    df = cols.add_metadata_columns(table(spark, folder, "lineitem"), ["record_id"])
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("record_id").alias("n_ids")
    )


@query(
    "standardize",
    r"""SELECT p_partkey,
    regexp_replace(lower(trim(p_name)), '[^a-zA-Z0-9_]', '', 'g') AS p_name,
    regexp_replace(lower(trim(p_brand)), '[^a-zA-Z0-9_]', '', 'g') AS p_brand,
    regexp_replace(lower(trim(p_type)), '[^a-zA-Z0-9_]', '', 'g') AS p_type,
    p_size, p_retailprice FROM part""",
)
def standardize(spark, folder):
    return cols.standardize_columns(table(spark, folder, "part"), True, True, True)


@query(
    "standardize_case",
    """SELECT c_custkey, lower(trim(c_name)) AS c_name, c_nationkey, c_acctbal,
    lower(trim(c_mktsegment)) AS c_mktsegment FROM customer""",
)
def standardize_case(spark, folder):
    return cols.standardize_columns(table(spark, folder, "customer"), True, True)


@query("rename_lower", "SELECT * FROM customer")
def rename_lower(spark, folder):
    upper = cols.rename_columns_to_uppercase(table(spark, folder, "customer"))
    return cols.rename_columns_to_lowercase(upper)


@query(
    "rename_upper",
    """SELECT o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY",
    o_orderstatus AS "O_ORDERSTATUS", o_totalprice AS "O_TOTALPRICE",
    o_orderdate AS "O_ORDERDATE", o_orderpriority AS "O_ORDERPRIORITY" FROM orders""",
)
def rename_upper(spark, folder):
    return cols.rename_columns_to_uppercase(table(spark, folder, "orders"))


@query(
    "rename_map",
    """SELECT c_custkey AS id, c_name AS name, c_nationkey, c_acctbal AS balance,
    c_mktsegment FROM customer""",
)
def rename_map(spark, folder):
    mapping = {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance", "absent": "x"}
    return cols.rename_columns_by_mapping(table(spark, folder, "customer"), mapping)


@query(
    "custom_columns",
    """SELECT o_orderkey, o_totalprice, o_orderdate,
    CAST(year(o_orderdate) AS INTEGER) AS order_year,
    CAST(month(o_orderdate) AS INTEGER) AS order_month,
    CASE WHEN o_totalprice > 200000 THEN 'large' ELSE 'small' END AS band,
    round(o_totalprice / nullif(month(o_orderdate) - 1, 0), 6) AS price_ratio
    FROM orders""",
)
def custom_columns(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return cols.add_custom_columns(
        df,
        {
            "order_year": "year(o_orderdate)",
            "order_month": "month(o_orderdate)",
            "broken": "no_such_column + 1",
            "band": "case when o_totalprice > 200000 then 'large' else 'small' end",
            "price_ratio": "round(try_divide(o_totalprice, order_month - 1), 6)",
        },
    )


@query(
    "fill_nulls",
    series_sql(
        USER_READINGS_SQL,
        """SELECT timestamp, turbine_id, hour, """
        + rounded_sql("coalesce(wind_speed, 0)", "wind_speed") + ", "
        + rounded_sql("coalesce(wind_direction, -1)", "wind_direction") + ", "
        + rounded_sql("power_output", "power_output") + " FROM completed",
    ),
)
def fill_nulls(spark, folder):
    completed = series.complete_grid(user_readings(spark, folder), START, END)
    return rounded(cols.fill_nulls(completed, {"wind_speed": 0.0, "wind_direction": -1.0}))


@query("drop_columns", "SELECT s_suppkey, s_name FROM supplier")
def drop_columns(spark, folder):
    return cols.drop_columns(
        table(spark, folder, "supplier"), ["s_nationkey", "s_acctbal", "absent"]
    )


@query("select_columns", "SELECT l_shipdate, l_orderkey, l_quantity FROM lineitem")
def select_columns(spark, folder):
    return cols.select_columns(
        table(spark, folder, "lineitem"), ["l_shipdate", "absent", "l_orderkey", "l_quantity"]
    )


# --- duplicates ------------------------------------------------------------


@query("dedupe_all", "SELECT DISTINCT user_id, event_type FROM events")
def dedupe_all(spark, folder):
    return remove_duplicates(table(spark, folder, "events").select("user_id", "event_type"))


@query("dedupe_subset", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedupe_subset(spark, folder):
    kept = remove_duplicates(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])
    return kept.select("l_orderkey", "l_linenumber")


@query(
    "dedupe_ordered",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey,
        l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
        FROM lineitem) WHERE rn = 1""",
)
def dedupe_ordered(spark, folder):
    return remove_duplicates(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    )


@query(
    "duplicate_counts",
    """SELECT count(*) AS source_count,
    count(DISTINCT (l_orderkey, l_linenumber)) AS target_count,
    count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS removed_count FROM lineitem""",
)
def dedupe_counts(spark, folder):
    return duplicate_counts(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- quality ---------------------------------------------------------------

LINE_RULES = {
    "l_orderkey": {"nulls_allowed": False, "data_type": "bigint"},
    "l_quantity": {"max_nulls_percent": 5, "data_type": "double", "min_value": 5, "max_value": 45},
    "l_discount": {"data_type": "string", "min_value": 0, "max_value": 1},
    "l_absent": {"nulls_allowed": False},
}

GRID_RULES = {
    "wind_speed": {"min_value": 20},
    "power_output": {"nulls_allowed": True, "max_value": 400},
    "hour": {"nulls_allowed": False, "max_value": 20},
}


@query(
    "quality_flag",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount, (l_orderkey IS NOT NULL
    AND l_quantity >= 5 AND l_quantity <= 45 AND l_discount >= 0 AND l_discount <= 1)
    AS quality_flag FROM lineitem""",
)
def quality_flag(spark, folder):
    df = qual.add_data_quality_flag(table(spark, folder, "lineitem"), LINE_RULES)
    return df.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "quality_flag")


@query(
    "quality_flag_nulls",
    series_sql(
        USER_READINGS_SQL,
        """SELECT timestamp, turbine_id, (wind_speed >= 20 AND power_output <= 400
        AND hour IS NOT NULL AND hour <= 20) AS quality_flag FROM completed""",
    ),
)
def quality_flag_nulls(spark, folder):
    completed = series.complete_grid(user_readings(spark, folder), START, END)
    flagged = qual.add_data_quality_flag(completed, GRID_RULES)
    return flagged.select("timestamp", "turbine_id", "quality_flag")


@query(
    "null_percent",
    series_sql(
        USER_READINGS_SQL,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name,
            round(100.0 * count(CASE WHEN {c} IS NULL THEN 1 END) / count(*), 4) AS null_percent
            FROM completed"""
            for c in ("hour", "wind_speed", "power_output")
        ),
    ),
)
def null_percent(spark, folder):
    completed = series.complete_grid(user_readings(spark, folder), START, END)
    return rounded(qual.null_percent(completed, ["hour", "wind_speed", "power_output"]))


def _report_line(column, rule, limit, observed, violations, passed) -> str:
    text = "NULL" if limit is None else f"'{limit}'"
    return f"""SELECT '{column}' AS column_name, '{rule}' AS rule,
        CAST({text} AS VARCHAR) AS rule_limit, CAST({observed} AS DOUBLE) AS observed,
        CAST({violations} AS BIGINT) AS violations, {passed} AS passed FROM lineitem"""


def _below(column: str, bound: float) -> str:
    return f"count(CASE WHEN {column} < {bound} THEN 1 END)"


def _above(column: str, bound: float) -> str:
    return f"count(CASE WHEN {column} > {bound} THEN 1 END)"


_NULL_KEYS = "count(CASE WHEN l_orderkey IS NULL THEN 1 END)"
_NULL_QUANTITIES = "100.0 * count(CASE WHEN l_quantity IS NULL THEN 1 END) / count(*)"

LINE_REPORT_SQL = [
    _report_line("*", "row_count", None, "count(*)", "0", "true"),
    _report_line("*", "column_count", None, "11", "0", "count(*) >= 0"),
    _report_line("l_orderkey", "nulls_allowed", "false", _NULL_KEYS, _NULL_KEYS, f"{_NULL_KEYS} = 0"),
    _report_line("l_orderkey", "data_type", "bigint", "NULL", "0", "count(*) >= 0"),
    _report_line("l_quantity", "max_nulls_percent", "5.0", _NULL_QUANTITIES, "0",
                 f"{_NULL_QUANTITIES} <= 5"),
    _report_line("l_quantity", "min_value", "5.0", "min(l_quantity)", _below("l_quantity", 5),
                 f"{_below('l_quantity', 5)} = 0"),
    _report_line("l_quantity", "max_value", "45.0", "max(l_quantity)", _above("l_quantity", 45),
                 f"{_above('l_quantity', 45)} = 0"),
    _report_line("l_quantity", "data_type", "double", "NULL", "0", "count(*) >= 0"),
    _report_line("l_discount", "min_value", "0.0", "min(l_discount)", _below("l_discount", 0),
                 f"{_below('l_discount', 0)} = 0"),
    _report_line("l_discount", "max_value", "1.0", "max(l_discount)", _above("l_discount", 1),
                 f"{_above('l_discount', 1)} = 0"),
    _report_line("l_discount", "data_type", "string", "NULL", "count(*)", "count(*) < 0"),
]


@query("quality_report", " UNION ALL ".join(LINE_REPORT_SQL))
def quality_report(spark, folder):
    return rounded(qual.quality_report(table(spark, folder, "lineitem"), LINE_RULES))


@query(
    "expectations_flagged",
    """SELECT quality_flag, count(*) AS n_rows, round(sum(l_quantity), 4) AS quantity FROM (
    SELECT l_quantity, (l_orderkey IS NOT NULL AND l_quantity >= 5 AND l_quantity <= 45
    AND l_discount >= 0 AND l_discount <= 1) AS quality_flag FROM lineitem) GROUP BY 1""",
)
def expectations_flagged(spark, folder):
    flagged = qual.validate_expectations(table(spark, folder, "lineitem"), LINE_RULES).flagged
    return rounded(
        flagged.groupBy("quality_flag").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("quantity")
        )
    )


LINE_BUSINESS_RULES = [
    ("l_discount > 0", "l_quantity > 30"),
    "l_tax between 0 and 0.05",
    "l_extendedprice > 1000 when l_quantity > 2",
]


@query(
    "business_rules",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_extendedprice,
    (NOT coalesce(l_quantity > 30, false) OR l_discount > 0) AS rule_1,
    (l_tax BETWEEN 0 AND 0.05) AS rule_2,
    (NOT coalesce(l_quantity > 2, false) OR l_extendedprice > 1000) AS rule_3 FROM lineitem""",
)
def business_rules(spark, folder):
    df = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice"
    )
    return qual.add_rule_results(df, LINE_BUSINESS_RULES)


@query(
    "table_profile",
    """SELECT 'orders' AS label, count(*) AS row_count, 6 AS column_count,
    'struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,'
    || 'o_orderdate:timestamp_ntz,o_orderpriority:string>' AS schema FROM orders""",
)
def table_profile(spark, folder):
    return qual.table_profile(table(spark, folder, "orders"), "orders")


# --- metrics ---------------------------------------------------------------

EVENT_METRICS = {
    "total_value": "sum(value)",
    "avg_value": "avg(value)",
    "max_value": "max(value)",
    "min_value": "min(value)",
    "user_count": "count(distinct user_id)",
    "record_count": "count(*)",
}


def _metrics_sql(unit: str) -> str:
    return f"""SELECT event_type, CAST(date_trunc('{unit}', ts) AS TIMESTAMP) AS agg_date,
    {rounded_sql("sum(value)", "total_value")}, {rounded_sql("avg(value)", "avg_value")},
    max(value) AS max_value, min(value) AS min_value,
    count(DISTINCT user_id) AS user_count, count(*) AS record_count
    FROM events GROUP BY 1, 2"""


def _metrics(grain: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        events = met.add_grain(table(spark, folder, "events"), grain, "ts")
        return rounded(met.calculate_metrics(events, EVENT_METRICS, ["event_type", "agg_date"]))

    return run


for _grain, _unit in (
    ("daily", "day"), ("hourly", "hour"), ("weekly", "week"), ("monthly", "month")
):
    query(f"metrics_{_grain}", _metrics_sql(_unit))(_metrics(_grain))


@query(
    "metrics_by_line",
    f"""SELECT l_returnflag, l_linestatus,
    {rounded_sql("round(sum(l_extendedprice * (1 - l_discount)), 2)", "revenue")},
    {rounded_sql("avg(l_quantity)", "avg_quantity")}, max(l_shipdate) AS last_ship,
    count(*) AS record_count FROM lineitem GROUP BY 1, 2""",
)
def metrics_by_line(spark, folder):
    return rounded(
        met.calculate_metrics(
            table(spark, folder, "lineitem"),
            {
                "revenue": "round(sum(l_extendedprice * (1 - l_discount)), 2)",
                "avg_quantity": "avg(l_quantity)",
                "last_ship": "max(l_shipdate)",
                "record_count": "count(*)",
            },
            ["l_returnflag", "l_linestatus"],
        )
    )


@query(
    "report_metadata",
    """SELECT event_type, count(*) AS record_count, true AS version_ok FROM events GROUP BY 1""",
)
def report_metadata(spark, folder):
    counted = met.calculate_metrics(
        table(spark, folder, "events"), {"record_count": "count(*)"}, ["event_type"]
    )
    report = met.add_report_metadata(counted)
    stamp = F.col("report_generated_at").cast("string")
    return report.select(
        "event_type", "record_count", (F.col("report_version") == stamp).alias("version_ok")
    )


# --- protection ------------------------------------------------------------

DEMO_KEY = "0123456789abcdef0123456789abcdef"


def _contacts(spark: SparkSession, folder: str) -> DataFrame:
    """E-mail addresses and phone numbers made from customer columns."""
    digits = F.substring("c_name", 10, 9)
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.concat(
            F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@"),
            F.lower("c_mktsegment"), F.lit(".example.com"),
        ).alias("email"),
        F.concat(
            F.substring(digits, 4, 3), F.lit("-"), F.substring(digits, 7, 3), F.lit("-"),
            F.lpad(F.col("c_nationkey").cast("string"), 4, "0"),
        ).alias("phone"),
    )


CONTACTS_SQL = """SELECT c_custkey,
    lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example.com' AS email,
    substr(substr(c_name, 10, 9), 4, 3) || '-' || substr(substr(c_name, 10, 9), 7, 3) || '-'
    || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS phone FROM customer"""
MASK_EMAIL_SQL = r"regexp_replace(email, '^(.)[^@]*@(.)[^.]*(\..*)$', '\1***@\2***\3')"
MASK_PHONE_SQL = r"regexp_replace(phone, '\d{3}-\d{3}-(\d{4})', 'XXX-XXX-\1', 'g')"


@query(
    "hash_token",
    "SELECT c_custkey, c_name, sha256(coalesce(c_name, '') || 'pepper') AS c_name_token "
    "FROM customer",
)
def hash_token(spark, folder):
    df = table(spark, folder, "customer").select("c_custkey", "c_name")
    return protect.hash_column(df, "c_name", "pepper")


@query(
    "hash_token_nulls",
    series_sql(
        USER_READINGS_SQL,
        """SELECT timestamp, turbine_id, sha256(coalesce(CAST(CAST(wind_direction AS BIGINT)
        AS VARCHAR), '') || 'x') AS direction_token FROM completed""",
    ),
)
def hash_token_nulls(spark, folder):
    completed = series.complete_grid(user_readings(spark, folder), START, END)
    direction = completed.select(
        "timestamp", "turbine_id", F.bround("wind_direction").cast("long").alias("direction")
    )
    return protect.hash_column(direction, "direction", "x").drop("direction")


@query(
    "token_mapping",
    "SELECT DISTINCT user_id, sha256(CAST(user_id AS VARCHAR) || 's') AS user_id_token FROM events",
)
def token_mapping(spark, folder):
    return protect.create_token_mapping(table(spark, folder, "events"), "user_id", "s")


@query(
    "mask_email",
    f"SELECT c_custkey, {MASK_EMAIL_SQL} AS email FROM ({CONTACTS_SQL})",
)
def mask_email(spark, folder):
    return protect.mask_email(_contacts(spark, folder).drop("phone"), "email")


@query(
    "mask_phone",
    f"SELECT c_custkey, {MASK_PHONE_SQL} AS phone FROM ({CONTACTS_SQL})",
)
def mask_phone(spark, folder):
    return protect.mask_phone(_contacts(spark, folder).drop("email"), "phone")


# Without look-around the characters beside a number are taken along.
PHONE_SQL = r"(^|[^0-9])(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-]([0-9]{4})($|[^0-9])"


@query(
    "mask_phone_documents",
    f"""SELECT doc_id, md5(masked) AS masked, masked <> text AS changed FROM (
    SELECT doc_id, text, regexp_replace(text, '{PHONE_SQL}', '\\1XXX-XXX-\\2\\3', 'g') AS masked
    FROM documents)""",
)
def mask_phone_documents(spark, folder):
    docs = table(spark, folder, "documents").withColumn("masked", F.col("text"))
    masked = protect.mask_phone(docs, "masked")
    return masked.select(
        "doc_id", F.md5("masked").alias("masked"), (F.col("masked") != F.col("text")).alias("changed")
    )


_LOCAL_SQL = r"""[^\x00-\x20@<>(),;:"\[\]\\]"""
EMAIL_TEXT_SQL = (
    rf"({_LOCAL_SQL}){_LOCAL_SQL}*@(\[?[\p{{L}}\p{{N}}])[\p{{L}}\p{{N}}-]*((?:\.[\p{{L}}\p{{N}}-]+)*)"
)


@query(
    "mask_email_documents",
    f"""SELECT doc_id, md5(masked) AS masked, masked <> text AS changed FROM (
    SELECT doc_id, text, CASE WHEN regexp_matches(text, '^[^\\x00-\\x20@]+@[^\\x00-\\x20@]+$')
      AND regexp_matches(text, '^(.)[^@]*@(.)[^.]*(\\..*)$')
      THEN regexp_replace(text, '^(.)[^@]*@(.)[^.]*(\\..*)$', '\\1***@\\2***\\3')
      ELSE regexp_replace(text, '{EMAIL_TEXT_SQL}', '\\1***@\\2***\\3', 'g') END AS masked
    FROM documents)""",
)
def mask_email_documents(spark, folder):
    docs = table(spark, folder, "documents").withColumn("masked", F.col("text"))
    masked = protect.mask_email(docs, "masked")
    return masked.select(
        "doc_id", F.md5("masked").alias("masked"), (F.col("masked") != F.col("text")).alias("changed")
    )


@query(
    "encrypt_typed",
    "SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders",
)
def encrypt_typed(spark, folder):
    df = table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day")
    )
    for column, kind in df.dtypes:
        hidden = protect.encrypt_column(df, column, DEMO_KEY)
        df = protect.decrypt_column(hidden, column, DEMO_KEY, data_type=kind)
    return df


@query("encrypt_roundtrip", "SELECT c_custkey, c_name, true AS hidden FROM customer")
def encrypt_roundtrip(spark, folder):
    df = table(spark, folder, "customer").select("c_custkey", "c_name")
    df = df.withColumn("cipher", F.col("c_name"))
    df = protect.encrypt_column(df, "cipher", DEMO_KEY)
    df = df.withColumn("hidden", F.col("cipher") != F.col("c_name"))
    df = protect.decrypt_column(df, "cipher", DEMO_KEY)
    return df.select("c_custkey", F.col("cipher").alias("c_name"), "hidden")


@query(
    "protect_policy",
    f"""SELECT {MASK_EMAIL_SQL} AS email, {MASK_PHONE_SQL} AS phone,
    sha256(CAST(c_custkey AS VARCHAR) || 'n') AS c_custkey_token FROM ({CONTACTS_SQL})""",
)
def protect_policy(spark, folder):
    return protect.protect_columns(
        _contacts(spark, folder),
        {
            "email": {"action": "mask_email"},
            "phone": {"action": "mask_phone"},
            "c_custkey": {"action": "hash", "salt": "n", "drop": True},
            "absent": {"action": "mask_email"},
        },
    )


# --- sources, sinks and jobs -----------------------------------------------


@query("csv_roundtrip", "SELECT * FROM customer")
def csv_roundtrip(spark, folder):
    path = new_path(spark, "csv")
    customer = table(spark, folder, "customer")
    customer.write.csv(path, header=True)
    return scan_files(spark, path, "CSV", {"header": True}, customer.schema)


@query("json_roundtrip", "SELECT * FROM orders")
def json_roundtrip(spark, folder):
    path = new_path(spark, "json")
    orders = table(spark, folder, "orders")
    orders.write.json(path)
    return scan_files(spark, path, "json", schema=orders.schema).select(*orders.columns)


@query("parquet_scan", "SELECT l_orderkey, l_tax FROM lineitem WHERE l_quantity > 25")
def parquet_scan(spark, folder):
    df = scan_files(spark, f"{folder}/lineitem.parquet", "parquet")
    return df.where("l_quantity > 25").select("l_orderkey", "l_tax")


@query("table_save", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def table_save(spark, folder):
    name = f"{scratch_database(spark)}.orders"
    orders = table(spark, folder, "orders")
    for mode in ("overwrite", "overwrite", "append"):
        save_table(orders, name, mode)
    return scan_table(spark, name)


@query(
    "partitioned_write",
    """SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""",
)
def partitioned_write(spark, folder):
    database, parts = scratch_database(spark), ["year", "month"]
    df = derive_partitions(table(spark, folder, "orders"), parts, "o_orderdate")
    save_table(df, f"{database}.orders", partitions=parts, root=new_path(spark, "root"))
    return scan_table(spark, f"{database}.orders")


@query(
    "evolving_append",
    """SELECT c_custkey, c_name, NULL::DOUBLE AS c_acctbal FROM customer UNION ALL
    SELECT c_custkey, NULL AS c_name, c_acctbal FROM customer""",
)
def evolving_append(spark, folder):
    name = f"{scratch_database(spark)}.customer"
    customer = table(spark, folder, "customer")
    save_table(customer.select("c_custkey", "c_name"), name)
    save_table(customer.select("c_custkey", "c_acctbal"), name, "append")
    return scan_table(spark, name)


@query(
    "publish_view",
    "SELECT o_orderstatus, count(*) AS record_count FROM orders GROUP BY 1",
)
def view_over_table(spark, folder):
    name = f"{scratch_database(spark)}.order_counts"
    counts = met.calculate_metrics(
        table(spark, folder, "orders"), {"record_count": "count(*)"}, ["o_orderstatus"]
    )
    save_table(counts, name)
    return scan_table(spark, publish_view(spark, name))


UPSERT_SQL = """SELECT o_orderkey, o_totalprice, o_orderdate,
    CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
    WHERE o_orderdate < TIMESTAMP '1996-01-01 00:00:00' UNION ALL
    SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, o_orderdate,
    CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'"""


def _upserted(spark: SparkSession, folder: str, partition_by: list[str]) -> DataFrame:
    """Two overlapping deliveries of orders; the later one has other prices."""
    name = f"{scratch_database(spark)}.orders"
    orders = derive_partitions(
        table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate"),
        ["year"], "o_orderdate",
    )
    first = orders.where("o_orderdate < timestamp_ntz'2000-01-01'")
    second = orders.where("o_orderdate >= timestamp_ntz'1996-01-01'").withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    keys = ["o_orderkey", "o_orderdate"]
    for delivery in (first, second, second):
        upsert(
            spark, delivery, name, keys, partition_by,
            partition_from={"year": "year(o_orderdate)"} if partition_by else None,
        )
    return rounded(scan_table(spark, name))


@query("upsert", UPSERT_SQL.replace("o_totalprice + 1", "round(o_totalprice + 1, 4)"))
def upsert_partitioned(spark, folder):
    return _upserted(spark, folder, ["year"])


@query("upsert_whole_table", UPSERT_SQL.replace("o_totalprice + 1", "round(o_totalprice + 1, 4)"))
def upsert_whole_table(spark, folder):
    return _upserted(spark, folder, [])


@query(
    "incremental_ingest",
    "SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS date FROM events",
)
def incremental_ingest(spark, folder):
    """Two deliveries of files, the second repeating rows of the first."""
    database, path = scratch_database(spark), new_path(spark, "deliveries")
    events = table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", "value", F.to_date("ts").alias("date")
    )
    early = events.where("date <= date'2024-01-20'").withColumn("value", F.col("value") - 1)
    late = events.where("date >= date'2024-01-20'")
    for delivery in (early, late, events):
        delivery.write.mode("append").parquet(path)
        ingest_new_files(
            spark, path, f"{database}.events", events.schema, "parquet",
            keys=["event_id", "date"], partition_by=["date"],
        )
    return scan_table(spark, f"{database}.events")


@query("incremental_append", "SELECT event_id, event_type, value FROM events")
def incremental_append(spark, folder):
    database, path = scratch_database(spark), new_path(spark, "deliveries")
    events = table(spark, folder, "events").select("event_id", "event_type", "value", "ts")
    early, late = "ts < timestamp_ntz'2024-01-15'", "ts >= timestamp_ntz'2024-01-15'"
    for condition in (early, late):
        events.where(condition).drop("ts").write.mode("append").json(path)
        ingest_new_files(
            spark, path, f"{database}.events", events.drop("ts").schema, "json"
        )
    return scan_table(spark, f"{database}.events").drop("ingest_batch", "ingest_file")


@query(
    "save_case_change",
    """SELECT c_custkey, c_name FROM customer
    UNION ALL SELECT c_custkey, c_name || '+' AS c_name FROM customer""",
)
def save_case_change(spark, folder):
    """Saved, overwritten and appended to under names of another case."""
    name = f"{scratch_database(spark)}.customer"
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    save_table(customer.limit(3), name)
    save_table(customer.toDF("C_CUSTKEY", "C_NAME"), name)
    save_table(customer.select("c_custkey", F.concat("c_name", F.lit("+")).alias("C_Name")), name, "append")
    return scan_table(spark, name)


@query(
    "upsert_many_partitions",
    """SELECT part, line, n + CASE WHEN (part, line) IN ((0, 1), (299, 7)) THEN 1000 ELSE 0 END AS n
    FROM (SELECT l_orderkey % 300 AS part, CAST(l_linenumber AS BIGINT) AS line, count(*) AS n
    FROM lineitem GROUP BY ALL)""",
)
def upsert_many_partitions(spark, folder):
    """Two partition columns with some 2,000 values; a delivery for two of them."""
    name = f"{scratch_database(spark)}.lines"
    counts = (
        table(spark, folder, "lineitem")
        .groupBy((F.col("l_orderkey") % 300).alias("part"), F.col("l_linenumber").cast("long").alias("line"))
        .agg(F.count("*").alias("n"))
    )
    upsert(spark, counts, name, ["part", "line"], ["part", "line"])
    ends = counts.where("(part = 0 AND line = 1) OR (part = 299 AND line = 7)")
    upsert(spark, ends.withColumn("n", F.col("n") + 1000), name, ["part", "line"], ["part", "line"])
    return scan_table(spark, name).select("part", "line", "n")


@query(
    "upsert_moving_partition",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END
    AS o_orderstatus FROM orders""",
)
def upsert_moving_partition(spark, folder):
    """All open orders are closed: their partition ends up empty."""
    name = f"{scratch_database(spark)}.orders"
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    upsert(spark, orders, name, ["o_orderkey"], ["o_orderstatus"])
    closed = orders.where("o_orderstatus = 'O'").withColumn("o_orderstatus", F.lit("F"))
    upsert(spark, closed, name, ["o_orderkey"], ["o_orderstatus"])
    return scan_table(spark, name)


@query(
    "upsert_new_column",
    """SELECT o_orderkey, o_orderstatus,
    CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END AS o_totalprice FROM orders""",
)
def upsert_new_column(spark, folder):
    name = f"{scratch_database(spark)}.orders"
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    upsert(spark, orders.drop("o_totalprice"), name, ["o_orderkey"])
    upsert(spark, orders.where("o_orderkey % 3 = 0"), name, ["o_orderkey"])
    return scan_table(spark, name)


DELIVERED_BYTES = 8 << 20


def deliver(df: DataFrame, path: str, name: str, files: int | None = None) -> None:
    """Parquet files of one delivery, new or in place of those of an older one.

    There are as many as the files that ``df`` reads have parts of ``DELIVERED_BYTES``, so
    neither their writer nor a task that reads them has more rows when there are more in
    all. Rows are dealt by their first column: a key is in the file of the same number,
    with all its copies, in every delivery of that name.
    """
    spark = df.sparkSession
    if files is None:
        size = sum(length for f in df.inputFiles() for _, length in files_below(spark, f))
        files = 1 + size // DELIVERED_BYTES
    written, folder = stage(df.repartition(files, df.columns[0]), "delivery")
    target = f"{path}/{name}.parquet"
    moved = []
    for file in written.inputFiles():
        number = re.search(r"part-(\d+)", file.rpartition("/")[2])[1]
        move(spark, file, f"{target}/{number}.parquet")
        moved.append(f"{number}.parquet")
    for file in children(spark, target):
        if file.rpartition("/")[2] not in moved:
            release(spark, file)
    release(spark, folder)


@query("ingest_two_sources", "SELECT event_id, event_type FROM events")
def ingest_two_sources(spark, folder):
    database, path = scratch_database(spark), new_path(spark, "deliveries")
    events = table(spark, folder, "events").select("event_id", "event_type")
    for source in ("odd", "even"):
        deliver(events.where(f"event_id % 2 = {int(source == 'odd')}"), path, source)
        for _ in range(2):
            ingest_new_files(spark, f"{path}/{source}.parquet", f"{database}.events", events.schema, "parquet")
    return scan_table(spark, f"{database}.events").select("event_id", "event_type")


@query("ingest_updated_file", "SELECT event_id, event_type FROM events")
def ingest_updated_file(spark, folder):
    """Each group's file is written anew, longer than before."""
    database, path = scratch_database(spark), new_path(spark, "deliveries")
    events = table(spark, folder, "events").select("event_id", "event_type")
    for part in ("event_id % 3 = 0", "true"):
        for group in (0, 1):
            deliver(events.where(f"event_id % 2 = {group}").where(part), path, f"group{group}")
        ingest_new_files(spark, f"{path}/*", f"{database}.events", events.schema, "parquet")
    return scan_table(spark, f"{database}.events").select("event_id", "event_type")


@query("ingest_redelivered", "SELECT event_id, event_type, value FROM events")
def ingest_redelivered(spark, folder):
    """Two files of one run hold the same keys; the one written last counts."""
    database, path = scratch_database(spark), new_path(spark, "deliveries")
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    deliver(events.withColumn("value", F.lit(None).cast("double")), path, "b-first")
    time.sleep(1.1)
    deliver(events, path, "a-second")
    ingest_new_files(
        spark, f"{path}/*", f"{database}.events", events.schema, "parquet", keys=["event_id"]
    )
    return scan_table(spark, f"{database}.events")


@query(
    "ingest_audit",
    """SELECT 'BRONZE' AS layer, 2 * count(*) AS source_count,
    count(*) AS target_count, 'SUCCESS' AS status FROM events""",
)
def ingest_audit(spark, folder):
    """Every row is there twice in its file; duplicates are dropped on the way."""
    database, path = scratch_database(spark), new_path(spark, "deliveries")
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    deliver(events.union(events), path, "twice")
    bronze = {
        "source": {
            "path": f"{path}/twice.parquet", "format": "parquet", "schema": events.schema, "incremental": True,
        },
        "transform": {"remove_duplicates": True},
        "destination": {"database": database, "table": "events", "keys": ["event_id"]},
        "audit": {
            "audit_table": f"{database}.audit", "error_table": f"{database}.errors",
        },
    }
    layers.run_bronze(spark, bronze)
    return scan_table(spark, f"{database}.audit").select(
        "layer", "source_count", "target_count", "status"
    )


@query(
    "layered_errors",
    """SELECT 'SILVER' AS layer, 'ValueError' AS error_type,
    'FAILED' AS status, count(*) AS source_count FROM events""",
)
def layered_errors(spark, folder):
    """A layer that fails leaves an error, and an audit row with what it had counted."""
    database = scratch_database(spark)
    save_table(table(spark, folder, "events").select("event_id", "value"), f"{database}.events")
    silver = {
        "source": {"database": database, "table": "events"},
        "destination": {"table": "silver", "partitions": ["region"]},
        "audit": {"audit_table": f"{database}.audit", "error_table": f"{database}.errors"},
    }
    try:
        layers.run_silver(spark, silver)
    except ValueError:
        pass
    errors, runs = scan_table(spark, f"{database}.errors"), scan_table(spark, f"{database}.audit")
    return errors.join(runs, ["run_id", "layer"]).select(
        "layer", "error_type", "status", "source_count"
    )


def layer_specs(database: str, folder: str) -> tuple[dict, dict, dict]:
    audit = {
        "audit_table": f"{database}.pipeline_audit",
        "error_table": f"{database}.pipeline_errors",
    }
    bronze = {
        "source": {"path": f"{folder}/events.parquet", "format": "parquet"},
        "transform": {
            "add_metadata_columns": ["load_timestamp", "source_file"],
            "column_case": "lowercase",
            "time_column": "ts",
        },
        "destination": {
            "database": database, "table": "bronze_events", "partitions": ["year", "month"],
        },
        "audit": audit,
    }
    silver = {
        "source": {"database": database, "table": "bronze_events"},
        "transform": {
            "deduplication": {"enabled": True},
            "standardization": {"enabled": True, "trim_strings": True, "lowercase": True},
            "quality_checks": {
                "enabled": True,
                "rules": {
                    "event_id": {"nulls_allowed": False, "data_type": "bigint"},
                    "value": {
                        "max_nulls_percent": 5, "data_type": "double",
                        "min_value": 0, "max_value": 200,
                    },
                },
                "report_table": f"{database}.quality",
            },
            "business_rules": {
                "enabled": True,
                "rules": ["value > 10 when event_type = 'purchase'", "user_id >= 0"],
            },
            "custom_columns": {"value_squared": "value * value"},
            "time_column": "ts",
        },
        "destination": {
            "database": database, "table": "silver_events", "partitions": ["year", "month"],
        },
        "audit": audit,
    }
    gold = {
        "source": {"database": database, "table": "silver_events"},
        "transform": {
            "aggregation_grain": "daily",
            "time_column": "ts",
            "custom_dimensions": {"band": "case when value > 100 then 'high' else 'low' end"},
            "dimensions": ["event_type", "band", "agg_date"],
            "metrics": {
                "total_value": "sum(value)",
                "avg_value": "avg(value)",
                "record_count": "count(*)",
            },
        },
        "destination": {
            "database": database, "table": "gold_events", "partitions": ["year", "month"],
            "create_view": True, "view_name": "gold_events_view",
        },
        "audit": audit,
    }
    return bronze, silver, gold


@query(
    "layered_run",
    f"""SELECT lower(trim(event_type)) AS event_type,
    CASE WHEN value > 100 THEN 'high' ELSE 'low' END AS band,
    CAST(date_trunc('day', ts) AS TIMESTAMP) AS agg_date,
    {rounded_sql("sum(value)", "total_value")}, {rounded_sql("avg(value)", "avg_value")},
    count(*) AS record_count, CAST(year(ts) AS INTEGER) AS year,
    CAST(month(ts) AS INTEGER) AS month
    FROM events GROUP BY 1, 2, 3, 7, 8""",
)
def layered_run(spark, folder):
    _, _, gold = layers.run_layers(spark, *layer_specs(scratch_database(spark), folder))
    return rounded(
        scan_table(spark, gold.view).drop("report_generated_at", "report_version")
    )


@query(
    "layered_audit",
    """SELECT 'BRONZE' AS layer, count(*) AS source_count, count(*) AS target_count,
    'SUCCESS' AS status FROM events UNION ALL
    SELECT 'SILVER', count(*), count(*), 'SUCCESS' FROM events UNION ALL
    SELECT 'GOLD', count(*), (SELECT count(*) FROM (SELECT DISTINCT event_type, value > 100,
    date_trunc('day', ts) FROM events)), 'SUCCESS' FROM events""",
)
def layered_audit(spark, folder):
    database = scratch_database(spark)
    layers.run_layers(spark, *layer_specs(database, folder))
    return scan_table(spark, f"{database}.pipeline_audit").select(
        "layer", "source_count", "target_count", "status"
    )


@query(
    "layered_quality",
    " UNION ALL ".join(
        line.replace("FROM lineitem", "FROM events")
        for line in [
            _report_line("*", "row_count", None, "count(*)", "0", "true"),
            _report_line("*", "column_count", None, "10", "0", "count(*) >= 0"),
            _report_line("event_id", "nulls_allowed", "false", "0", "0", "count(*) >= 0"),
            _report_line("event_id", "data_type", "bigint", "NULL", "0", "count(*) >= 0"),
            _report_line("value", "max_nulls_percent", "5.0", "0", "0", "count(*) >= 0"),
            _report_line("value", "min_value", "0.0", "min(value)", _below("value", 0),
                         f"{_below('value', 0)} = 0"),
            _report_line("value", "max_value", "200.0", "max(value)", _above("value", 200),
                         f"{_above('value', 200)} = 0"),
            _report_line("value", "data_type", "double", "NULL", "0", "count(*) >= 0"),
            _report_line(
                "rule_1", "business_rule", "value > 10 when event_type = ''purchase''", "NULL",
                "count(CASE WHEN event_type = 'purchase' AND NOT value > 10 THEN 1 END)",
                "count(CASE WHEN event_type = 'purchase' AND NOT value > 10 THEN 1 END) = 0",
            ),
            _report_line("rule_2", "business_rule", "user_id >= 0", "NULL",
                         _below("user_id", 0), f"{_below('user_id', 0)} = 0"),
        ]
    ),
)
def layered_quality(spark, folder):
    database = scratch_database(spark)
    bronze, silver, _ = layer_specs(database, folder)
    layers.run_bronze(spark, bronze)
    layers.run_silver(spark, silver)
    return scan_table(spark, f"{database}.quality")

"""Session settings the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

# hour(), to_date() and date_trunc() depend on the zone, so it is pinned.
# Adaptive execution does the run-time work that depends on data size:
# coalescing small shuffle partitions, splitting skewed ones and switching to
# a broadcast once a join side is known to be small.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Files are smaller than the rows in them. Counting them at four times their
    # size makes the broadcast limit one on memory; the limit suits executors
    # of a few GB.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # Keys of ciphers are binary literals of 16 to 32 bytes; plans do not show them.
    "spark.sql.redaction.string.regex": r"0x[0-9A-Fa-f]{32,64}|X'[0-9A-Fa-f]{32,64}'",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.csv.filterPushdown.enabled": "true",
}


def get_session(
    app_name: str = "tierflow",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build or fetch a session; values in ``conf`` win over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

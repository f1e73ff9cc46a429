"""Publication of a whole table at once.

A new state is written to a location of its own, beside that of the old one, and
becomes the table's by a single change in the catalog. Until then every reader
sees the old state, and one that has planned its read before still finds the old
files, since a number of earlier states is kept. A write that fails leaves the
table as it was.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.sinks.tables import stored_as
from tierflow.staging import children, release

# Locations of later states: beside the first one, named so that they sort by age.
BESIDE = "__snapshots"
FILE_BYTES = 128 << 20
# Rows that a task must sort or group at once, as they are stored. Shuffles of very
# many parts cost more than tasks that spill, so beyond 40 GB parts grow instead.
PART_BYTES, MOST_PARTS = 4 << 20, 10_000


def table_location(spark: SparkSession, table: str) -> str:
    """The folder that the catalog names for a table."""
    lines = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return lines.select("data_type").first()[0].rstrip("/")


def _first_location(location: str) -> str:
    parent, _, _ = location.rpartition("/")
    return parent.removesuffix(BESIDE) if parent.endswith(BESIDE) else location


def snapshots(spark: SparkSession, table: str) -> list[str]:
    """Locations of all states that are still there, the oldest first."""
    first = _first_location(table_location(spark, table))
    later = sorted(children(spark, first + BESIDE))
    return ([first] if children(spark, first) else []) + later


def publish_snapshot(df: DataFrame, table: str, retain: int = 1) -> str:
    """Make ``df`` the content of an unpartitioned file table, by one write.

    ``df`` may read the table itself. The ``retain`` states before this one stay
    for readers that have begun; older ones are deleted. Of writers of one table
    the last to name its state wins. Partitions have locations of their own in the
    catalog, so a partitioned table cannot be switched by one call and is an error.
    """
    spark = df.sparkSession
    provider, partitions = stored_as(spark, table)
    if partitions:
        raise ValueError(f"{table} is partitioned by {partitions}; it cannot be published at once")
    first = _first_location(table_location(spark, table))
    location = f"{first}{BESIDE}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    rows = df.select(*[F.col(f"`{c}`") for c in spark.table(table).columns])
    try:
        rows.write.format(provider).save(location)
    except BaseException:
        release(spark, location)
        raise
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)
    for old in snapshots(spark, table)[: -1 - retain]:
        release(spark, old)
    return location


def drop_earlier(spark: SparkSession, table: str) -> None:
    """Delete the states before the present one, if there are any."""
    location = table_location(spark, table)
    if location != _first_location(location):
        for old in snapshots(spark, table):
            if not old.endswith(location.rpartition("/")[2]):
                release(spark, old)


def compact_table(spark: SparkSession, table: str, most_files: int = 64) -> bool:
    """Rewrite a small table that has come to more than ``most_files`` files, as few.

    For ledgers and indexes that gain a file by every run. Readers see the same
    rows throughout. Returns whether it was rewritten.
    """
    rows = spark.table(table)
    if len(rows.inputFiles()) <= most_files:
        return False
    size = sum(length for _, length in files_below(spark, table_location(spark, table)))
    publish_snapshot(rows.coalesce(max(1, -(-size // FILE_BYTES))), table)
    return True


def parts_for(size: int) -> int:
    """Tasks to deal stored rows of ``size`` bytes to, so that each holds its share in memory."""
    return min(1 + size // PART_BYTES, MOST_PARTS)


def stored_bytes(df: DataFrame) -> int:
    """Size of the folders whose files ``df`` reads; 0 if it reads none."""
    folders = {f.rpartition("/")[0] for f in df.inputFiles()}
    return sum(size for folder in folders for _, size in files_below(df.sparkSession, folder))


def files_below(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Files directly in a folder, with their sizes."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    return [(s.getPath().toString(), s.getLen()) for s in system.listStatus(target) if s.isFile()]

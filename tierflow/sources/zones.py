"""Time windows over many files, reading those that may hold rows of the window.

A zone map is a table beside the data that knows, per file as it was, the first
and last time in it. Files whose range misses the window are not opened. Files
that the map does not know, new or changed ones, are parsed once: their rows are
stored, their ranges enter the map, and the window is taken from what was stored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierflow.sinks.snapshots import compact_table
from tierflow.sinks.tables import table_exists
from tierflow.sources.files import in_window, list_files, scan_files, window_bounds
from tierflow.staging import stage, staged

STATE = ["file", "modified", "size"]
STATE_OF_ROW = {
    "__file": "_metadata.file_path",
    "__modified": "_metadata.file_modification_time",
    "__size": "_metadata.file_size",
}


@dataclass(frozen=True)
class Pruned:
    """The rows of a window, and how many files were opened for them, and left alone."""

    rows: DataFrame
    opened: int
    skipped: int


class ZoneMap:
    """The ranges of ``time_column`` in files, kept as the table ``table``."""

    def __init__(self, spark: SparkSession, table: str, time_column: str = "timestamp"):
        self.spark, self.table, self.time_column = spark, table, time_column

    def known(self, listed: DataFrame) -> DataFrame:
        """Files with their ``first`` and ``last`` time; ``rows`` is null where nothing is known."""
        if not table_exists(self.spark, self.table):
            return listed.withColumns({c: F.lit(None).cast("timestamp") for c in ("first", "last")} | {"rows": F.lit(None).cast("long")})
        # A file that two runs have read has two equal entries.
        zones = self.spark.table(self.table).dropDuplicates(STATE)
        return listed.join(zones, STATE, "left")

    def learn(self, rows: DataFrame, files: DataFrame) -> None:
        """Enter ``files`` with the ranges of ``rows``, which carry the state of their file."""
        time = F.col(f"`{self.time_column}`")
        ranges = rows.groupBy(*[F.col(f"__{c}").alias(c) for c in STATE]).agg(
            F.min(time).alias("first"), F.max(time).alias("last"), F.count("*").alias("rows")
        )
        # A file without rows is known, too.
        every = files.select(*STATE).join(ranges, STATE, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
        every.coalesce(1).write.mode("append").saveAsTable(self.table)
        compact_table(self.spark, self.table)

    @contextmanager
    def window(
        self,
        path: str | list[str],
        start: datetime | date | str,
        end: datetime | date | str,
        schema: StructType | str,
        file_format: str = "csv",
        options: Mapping[str, Any] | None = None,
    ) -> Iterator[Pruned]:
        """Rows of all files whose time lies in the closed window, for the length of a block.

        The rows are those that ``load_window`` gives. The names of the files that
        are read come to the driver, where a scan is planned; all others stay in
        the store. A file that changes between listing and reading is read as it is
        then, and entered under the state it was read in.
        """
        spark, time = self.spark, self.time_column
        options = {"header": "true", **(options or {})} if file_format == "csv" else options

        def scan(paths: list[str]) -> DataFrame:
            return scan_files(spark, paths, file_format, options, schema)

        empty = spark.createDataFrame([], schema)
        inside = in_window(empty, time, start, end)
        with staged(list_files(spark, path), "files") as listed:
            files, _ = stage(self.known(listed), "zones")
            total = files.count()
            new = files.where("rows IS NULL")
            kind = dict(empty.dtypes)[time]
            begin, stop = window_bounds(kind, start, end)
            meets = (F.col("first").cast(kind) <= stop) & (F.col("last").cast(kind) >= begin)
            met = files.where("rows > 0").where(meets)
            old_paths = [r.path for r in met.select("path").collect()]
            new_paths = [r.path for r in new.select("path").collect()]
            rows = scan(old_paths).where(inside) if old_paths else empty.where(F.lit(False))
            if not new_paths:
                yield Pruned(rows, len(old_paths), total - len(old_paths))
                return
            fresh = scan(new_paths).select("*", *[F.col(m).alias(c) for c, m in STATE_OF_ROW.items()])
            with staged(fresh, "unknown") as stored:
                self.learn(stored, new)
                found = stored.drop(*STATE_OF_ROW).where(inside)
                opened = len(old_paths) + len(new_paths)
                yield Pruned(rows.unionByName(found), opened, total - opened)

"""Ingest of files that are new or have changed since the last run.

A ledger table next to the target names every ingested file with its time of
change and size. A run lists the files, reads those that are not in the ledger as
they are now, whatever their age, and enters them last. A run that broke off
before that is made good by the next one: with keys because an upsert may be
repeated, without keys because the rows of the unfinished batch are cleared.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierflow.operators.dedupe import own_group
from tierflow.operators.observe import Watch
from tierflow.sinks.snapshots import compact_table, parts_for
from tierflow.sinks.tables import (
    align_with_table,
    clear_partition,
    replace_partitions,
    save_table,
    table_exists,
)
from tierflow.sinks.upsert import upsert
from tierflow.sources.files import list_files, scan_files
from tierflow.staging import stage, staged
from tierflow.streaming.seen import RowIndex

BATCH_COLUMN = "ingest_batch"
FILE_COLUMN = "ingest_file"
TIME_COLUMN = "ingest_file_time"
LEDGER_SCHEMA = "file string, modified timestamp, size long, batch long, done boolean"


@dataclass(frozen=True)
class Ingested:
    """What a run did: files read, their rows, rows handed to the table."""

    files: int = 0
    source_count: int = 0
    target_count: int = 0


def ledger_of(table: str) -> str:
    return f"{table}__ingested_files"


def pending_files(spark: SparkSession, path: str | list[str], ledger: str) -> DataFrame:
    """Files that the ledger lacks as they are now."""
    listed = list_files(spark, path)
    if table_exists(spark, ledger):
        known = spark.table(ledger).where("done").select("file", "modified", "size")
        listed = listed.join(known, ["file", "modified", "size"], "left_anti")
    return listed


def batches_of_files(
    files: DataFrame, max_files: int | None = None, max_bytes: int | None = None
) -> Iterator[list[Row]]:
    """Files, oldest first, batch by batch; the driver holds the names of one batch.

    A scan of named files is planned on the driver. With a limit the list is stored
    and cut there, where a running count or sum of sizes passes a multiple of it, so
    a batch exceeds ``max_bytes`` by less than its last file. Without a limit there
    is one batch.
    """
    order = ["modified", "file"]
    if not (max_files or max_bytes):
        found = files.orderBy(*order).collect()
        yield from [found] if found else []
        return
    spark = files.sparkSession
    dealt = files.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    with staged(dealt, "pending") as listed:
        # Sums run within each range of files; a range begins where those before it end.
        parts = listed.groupBy("part").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
        starts, n, size = [], 0, 0
        for r in sorted(parts.collect()):
            starts.append((r.part, n, size))
            n, size = n + r.n, size + r.bytes
        offsets = spark.createDataFrame(starts, "part int, n long, bytes long")
        before = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        at_file = F.col("n") + F.count("*").over(before)
        at_byte = F.col("bytes") + F.coalesce(F.sum("size").over(before), F.lit(0))
        cut = listed.join(offsets, "part").select(
            *files.columns,
            F.floor(at_file / (max_files or 2**62)).alias("by_count"),
            F.floor(at_byte / (max_bytes or 2**62)).alias("by_size"),
        )
        with staged(cut, "batches") as numbered:
            for numbers in sorted(numbered.select("by_count", "by_size").distinct().collect()):
                chosen = (F.col("by_count") == numbers.by_count) & (F.col("by_size") == numbers.by_size)
                yield numbered.where(chosen).select(*files.columns).orderBy(*order).collect()


def newest_per_key(df: DataFrame, keys: Sequence[str], size: int | None = None) -> DataFrame:
    """Of rows that share a key those of the file that changed last.

    Rows with a null key equal nothing and all stay. The rows are read once. With
    the ``size`` of the files in bytes they are dealt by key as they are read, and
    sorted once, in tasks that hold no more when there are more files. A key has at
    most a row of each file, or the copies in it, so nothing is gained from sorting
    the rows of a task that reads them.
    """
    df = df.withColumn("__own_group", own_group(keys))
    groups = [*keys, "__own_group"]
    if size is not None:
        df = df.repartition(parts_for(size), *groups)
    newest = Window.partitionBy(*groups).orderBy(F.desc(TIME_COLUMN), F.desc(FILE_COLUMN))
    ranked = df.withColumn("file_rank", F.rank().over(newest)).where("file_rank = 1")
    return ranked.drop("file_rank", "__own_group")


class _Ledger:
    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.name = spark, ledger_of(table)

    def enter(self, files: list[Row], batch: int, done: bool) -> None:
        rows = [(f.file, f.modified, f.size, batch, done) for f in files]
        entries = self.spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1)
        entries.write.mode("append").saveAsTable(self.name)

    def unfinished(self) -> list[int]:
        batches = self.spark.table(self.name).groupBy("batch").agg(F.max("done").alias("done"))
        return [r.batch for r in batches.where("NOT done").collect()]

    def batches_of(self, files: list[Row]) -> list[int]:
        """Batches that earlier states of these files went to."""
        names = self.spark.createDataFrame([(f.file,) for f in files], "file string")
        found = self.spark.table(self.name).join(names, "file", "left_semi")
        return [r.batch for r in found.where("done").select("batch").distinct().collect()]


def _named(df: DataFrame) -> DataFrame:
    """The file columns under their own names, whatever a transform made of their case."""
    own = {c.lower(): c for c in (FILE_COLUMN, TIME_COLUMN)}
    df = df.withColumnsRenamed({c: own[c.lower()] for c in df.columns if c.lower() in own})
    lost = sorted(set(own.values()) - set(df.columns))
    if lost:
        raise ValueError(f"the transform of an ingest must keep {lost}")
    return df


def ingest_new_files(
    spark: SparkSession,
    path: str | list[str],
    table: str,
    schema: StructType | str,
    file_format: str = "csv",
    options: Mapping[str, Any] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    keys: Sequence[str] | None = None,
    dedupe_source_on: Sequence[Column | str] | None = None,
    partition_by: Sequence[str] = (),
    root: str | None = None,
    max_files_per_batch: int | None = None,
    table_format: str = "parquet",
    merge_schema: bool = True,
    max_bytes_per_batch: int | None = None,
    distinct_on: Callable[[Sequence[str]], Sequence[str]] | None = None,
) -> Ingested:
    """Bring ``table`` up to date with files that are new or have changed.

    With ``keys`` rows are upserted: late, changed or re-delivered rows replace
    what is stored, and of rows of one run the newest file's win. Rows of one
    file that share a key are an error unless ``dedupe_source_on`` orders them.
    Without keys rows are added, with ``ingest_batch`` as first partition column,
    and the rows of a changed file replace those it had before.

    Files are known by their path, so any number of sources may go into one
    table. A table without its ledger takes no unkeyed files, as it could not be
    told which of them it holds. ``transform`` is given the columns
    ``ingest_file`` and ``ingest_file_time`` as well, and must keep them.

    ``distinct_on``, for tables without keys, picks the columns that make two rows
    the same. Then a row that the table has, from whatever file and run, is not
    added again, as if all files had been read at once and their duplicates removed.
    When a file changes, those are read again whose rows were left out for its sake;
    a row that only a file no longer there could give back stays left out.
    """
    ledger = _Ledger(spark, table)
    index = RowIndex(spark, table, ledger.name, FILE_COLUMN, BATCH_COLUMN) if distinct_on and not keys else None
    if not table_exists(spark, table):
        spark.sql(f"DROP TABLE IF EXISTS {ledger.name}")
        if index:
            index.clear()
    elif not keys and not table_exists(spark, ledger.name):
        raise ValueError(f"{table} exists without its ledger {ledger.name}")
    elif not keys:
        for batch in ledger.unfinished():
            clear_partition(spark, table, {BATCH_COLUMN: batch})
    pending = pending_files(spark, path, ledger.name)
    limits = max_files_per_batch, max_bytes_per_batch
    dependents: list[DataFrame] = []

    def batches() -> Iterator[list[Row]]:
        for files in batches_of_files(pending, *limits):
            # Found before the files' earlier states go, read once all new ones are in.
            if index and index.exists() and ledger.batches_of(files):
                names = spark.createDataFrame([(f.file,) for f in files], "file string")
                dependents.append(stage(index.dependents(names), "dependents")[0])
            yield files
        if dependents:
            names = reduce(DataFrame.union, dependents).distinct()
            again = list_files(spark, path).join(names, "file", "left_semi").select(*pending.columns)
            yield from batches_of_files(again, *limits)

    total = Ingested()
    for files in batches():
        scan = scan_files(spark, [f.path for f in files], file_format, options, schema)
        read = Watch.rows(
            scan.withColumns(
                {
                    FILE_COLUMN: F.col("_metadata.file_path"),
                    TIME_COLUMN: F.col("_metadata.file_modification_time"),
                }
            )
        )
        df = _named(transform(read.df) if transform else read.df)
        batch = time.time_ns() // 1000
        if keys:
            newest = newest_per_key(df, keys, sum(f.size for f in files))
            with staged(newest.drop(FILE_COLUMN, TIME_COLUMN), "ingest") as rows:
                written = rows.count()
                upsert(
                    spark, rows, table, keys, partition_by, table_format, root,
                    dedupe_source_on, source_is_stored=True,
                )
        else:
            df = df.drop(TIME_COLUMN).withColumn(BATCH_COLUMN, F.lit(batch).cast("long"))
            ledger.enter(files, batch, False)
            parts = [BATCH_COLUMN, *partition_by]
            if index:
                own = {FILE_COLUMN, BATCH_COLUMN}
                columns = distinct_on([c for c in df.columns if c not in own])
                with staged(df, "ingest") as rows:
                    df, entries = index.unseen(rows, columns, batch)
                    written = _add(ledger, df, files, table, parts, root, table_format, merge_schema)
                    index.add(entries)
            else:
                written = _add(ledger, df, files, table, parts, root, table_format, merge_schema)
        ledger.enter(files, batch, True)
        total = Ingested(
            total.files + len(files), total.source_count + read.row_count, total.target_count + written
        )
    if total.files:
        compact_table(spark, ledger.name)
    return total


def _add(ledger, df, files, table, parts, root, table_format, merge_schema) -> int:
    """Write one batch, and rewrite batches that hold earlier states of its files."""
    spark = df.sparkSession
    if not table_exists(spark, table):
        watch = Watch.rows(df)
        save_table(watch.df, table, "overwrite", table_format, parts, root)
        return watch.row_count
    watch = Watch.rows(align_with_table(df, table, add_columns=merge_schema))
    earlier, rows, emptied = ledger.batches_of(files), watch.df, []
    if earlier:
        names = spark.createDataFrame([(f.file,) for f in files], f"{FILE_COLUMN} string")
        stored = spark.table(table)
        rest = stored.where(F.col(BATCH_COLUMN).isin(earlier)).join(names, FILE_COLUMN, "left_anti")
        left = {r[0] for r in rest.select(BATCH_COLUMN).distinct().collect()}
        emptied = [b for b in earlier if b not in left]
        rows = rows.select(*stored.columns).union(rest.select(*stored.columns))
    replace_partitions(rows, table)
    for batch in emptied:
        clear_partition(spark, table, {BATCH_COLUMN: batch})
    return watch.row_count

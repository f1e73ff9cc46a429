"""Keyed upsert: matched rows are replaced whole, the others inserted.

A table whose format supports row-level changes gets a ``MERGE INTO``. A file
table is rewritten by partition: only partitions that hold a matched row or get
a new one are replaced, the others keep their files. Where partition columns are
among the keys, or are given as expressions over them, the source alone names
those partitions. Otherwise a row may have moved, so the keys of the whole target
are read to find the partitions of matched rows.

On a partitioned file table the new partitions are moved into place one after the
other when the job commits, so a reader may see some before others. A table
without partitions is published as a whole: readers see all of an upsert or none.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.dedupe import remove_duplicates
from tierflow.sinks.snapshots import parts_for, publish_snapshot, stored_bytes
from tierflow.sinks.tables import (
    align_with_table,
    clear_partition,
    name_rule,
    rebalance,
    replace_partitions,
    save_table,
    stored_as,
    table_exists,
)
from tierflow.staging import staged

FILE_PROVIDERS = ("parquet", "orc", "csv", "json")

def merge_statement(target: str, source: str, keys: Sequence[str]) -> str:
    condition = " AND ".join(f"target.`{k}` = source.`{k}`" for k in keys)
    return (
        f"MERGE INTO {target} AS target USING {source} AS source ON {condition} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def repeated_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that several rows share, with their number; null keys equal nothing.

    Keys of stored rows are hardly ever repeated, so they are dealt before they are
    grouped, to as many tasks as the files ask for.
    """
    held = source.dropna(subset=list(keys)).select(*keys)
    if size := stored_bytes(source):
        held = held.repartition(parts_for(size), *keys)
    return held.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def check_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise if two source rows share a key; null keys equal nothing."""
    repeated = repeated_keys(source, keys).limit(1).collect()
    if repeated:
        raise ValueError(f"several source rows share one key: {repeated[0].asDict()}")


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of the target after the upsert.

    Only the keys of the source take part in the join; its rows pass through.
    Null keys match nothing, so those source rows are inserted.
    """
    kept = target.join(source.select(*keys), on=list(keys), how="left_anti")
    return kept.select(*target.columns).unionByName(source)


def touched_partitions(source: DataFrame, columns: Sequence[str]) -> Column:
    """Condition on partition columns that holds for every partition of ``source``.

    It consists of literals, so the scan of the target skips all other partitions.
    The list of values comes to the driver, as that of a commit does anyway. Several
    columns are compared as one text, nulls included, so the condition is a look-up
    in a set however many there are.
    """
    if len(columns) == 1:
        column = F.col(f"`{columns[0]}`")
        values = [r[0] for r in source.select(column).distinct().collect()]
        condition = column.isin([v for v in values if v is not None])
        return condition | column.isNull() if None in values else condition
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]))
    return whole.isin([r[0] for r in source.select(whole).distinct().collect()])


def upsert(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    file_format: str = "parquet",
    root: str | None = None,
    dedupe_source_on: Sequence[Column | str] | None = None,
    source_is_stored: bool = False,
    keys_are_unique: bool = False,
    partition_from: Mapping[str, str] | None = None,
) -> None:
    """Merge ``df`` into ``table`` on equal ``keys``; create the table if absent.

    Two source rows with one key are an error, as it would be unclear which one
    to keep. With ``dedupe_source_on`` the first one in that order is kept
    instead; ``keys_are_unique`` skips the check where the source is known to
    be right, as after grouping by the keys.

    ``partition_from`` gives partition columns as SQL expressions over the keys,
    such as ``{"date": "to_date(timestamp)"}``; they are worked out here, so a key
    can have one partition only.

    Columns that only the source has are added to the table, and columns it lacks
    become null in its rows. The source is read several times, so it is staged
    first unless it ``source_is_stored`` already.
    """
    derived = {c: F.expr(e) for c, e in (partition_from or {}).items()}
    if derived:
        df = df.withColumns(derived)
    if dedupe_source_on:
        df = remove_duplicates(df, keys, dedupe_source_on, null_keys_differ=True)
        keys_are_unique, source_is_stored = True, False
    with nullcontext(df) if source_is_stored else staged(df, "upsert-source") as source:
        if not keys_are_unique:
            check_unique(source, keys)
        if table_exists(spark, table):
            _merge(spark, source, table, keys, {*keys, *derived})
        else:
            save_table(
                rebalance(source, partition_by),
                table, "overwrite", file_format, partition_by, root,
            )


def _merge(
    spark: SparkSession, source: DataFrame, table: str, keys: Sequence[str], fixed: set[str]
) -> None:
    provider, partitions = stored_as(spark, table)
    source = align_with_table(source, table, add_columns=True)
    if provider not in FILE_PROVIDERS:
        view = f"upsert_source_{uuid.uuid4().hex}"
        source.createOrReplaceTempView(view)
        try:
            spark.sql(merge_statement(table, view, keys))
        finally:
            spark.catalog.dropTempView(view)
        return

    target = spark.table(table)
    types = {f.name: f.dataType for f in target.schema}
    source = source.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in types.items()])
    fold = name_rule(spark)
    if partitions and {fold(p) for p in partitions} <= {fold(c) for c in fixed}:
        target = target.where(touched_partitions(source, partitions))
        replace_partitions(rebalance(merge_rows(target, source, keys), partitions), table)
    elif partitions:
        # Rows may leave a partition, which then might end up without any.
        held = target.select(*dict.fromkeys([*keys, *partitions]))
        matched = held.join(source.select(*keys), on=list(keys), how="left_semi")
        every = source.select(*partitions).union(matched.select(*partitions))
        touched = target.where(touched_partitions(every, partitions))
        with staged(merge_rows(touched, source, keys), "upsert-result") as merged:
            left = merged.select(*partitions).distinct()
            emptied = matched.select(*partitions).distinct().subtract(left).collect()
            replace_partitions(rebalance(merged, partitions), table)
            for values in emptied:
                clear_partition(spark, table, values.asDict())
    else:
        # Written once, beside the files that are read, and named in one step.
        publish_snapshot(merge_rows(target, source, keys), table)

"""Saves to catalog tables, and views over them."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def external_path(root: str, name: str) -> str:
    """``{root}/{database}.db/{table}``, the usual warehouse shape."""
    *_, database, table = ["default", *name.split(".")]
    return f"{root.rstrip('/')}/{database}.db/{table}"


def derive_partitions(
    df: DataFrame, partitions: Sequence[str], time_column: str
) -> DataFrame:
    """Add partition columns ``year``, ``month``, ``day`` or ``date`` if absent."""
    time = F.col(time_column)
    known = {
        "year": F.year(time),
        "month": F.month(time),
        "day": F.dayofmonth(time),
        "date": F.to_date(time),
    }
    present = {c.lower() for c in df.columns}
    absent = [p for p in partitions if p.lower() not in present]
    unknown = [p for p in absent if p not in known]
    if unknown:
        raise ValueError(f"partition columns {unknown} are not columns of the table")
    if absent and time_column.lower() not in present:
        raise ValueError(f"{absent} need the time column {time_column}, which is absent")
    return df.withColumns({p: known[p] for p in absent}) if absent else df


def rebalance(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Gather each partition's rows into few files of moderate size.

    This shuffles. It is for rows that are spread over many partitions, and is
    not needed where each task holds rows of few of them anyway. Adaptive execution splits a partition value that holds too many rows over
    several tasks and joins small ones together, so no value ends up in one
    task however much of the table it holds.
    """
    return df.hint("rebalance", *partitions) if partitions else df


def name_rule(spark: SparkSession) -> Callable[[str], str]:
    """What makes two column names the same one in this session."""
    exact = spark.conf.get("spark.sql.caseSensitive") == "true"
    return str if exact else str.lower


def align_with_table(df: DataFrame, name: str, add_columns: bool) -> DataFrame:
    """Give ``df`` the columns of the stored table, nulls where it lacks them.

    Names are compared as the session does and become the stored ones. Two columns
    that are one by that rule are an error. With ``add_columns`` the stored table
    first gains the columns only ``df`` has; files written before then read as
    null in them.
    """
    spark = df.sparkSession
    fold, stored = name_rule(spark), spark.table(name).schema
    folded = [fold(c) for c in df.columns]
    clashes = sorted({c for c in df.columns if folded.count(fold(c)) > 1})
    if clashes:
        raise ValueError(f"columns {clashes} are the same by the session's case rule")
    named = {fold(f.name): f.name for f in stored.fields}
    df = df.toDF(*[named.get(fold(c), c) for c in df.columns])
    new = [f for f in df.schema.fields if fold(f.name) not in named]
    if new and add_columns:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({ddl})")
    absent = [f for f in stored.fields if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    file_format: str = "parquet",
    partitions: Sequence[str] = (),
    root: str | None = None,
    merge_schema: bool = True,
    at_once: bool = False,
) -> None:
    """Write ``df`` as the catalog table ``name``.

    ``root`` puts it at an external location below that folder. With
    ``merge_schema`` the stored table keeps columns that ``df`` lacks and gains
    those it adds, in append as in overwrite mode. With ``at_once`` readers of an
    unpartitioned table that is overwritten see the old rows or the new, never
    neither; see ``publish_snapshot``.
    """
    from tierflow.sinks import snapshots

    spark = df.sparkSession
    exists = table_exists(spark, name)
    at_once = at_once and exists and mode == "overwrite"
    if exists and merge_schema:
        df = align_with_table(df, name, add_columns=mode == "append" or at_once)
    if at_once:
        snapshots.publish_snapshot(df, name)
        return
    if exists and mode == "overwrite":
        snapshots.drop_earlier(spark, name)
    writer = df.write.format(file_format).mode(mode)
    if file_format == "delta" and merge_schema:
        writer = writer.option("mergeSchema", "true")
    if partitions:
        writer = writer.partitionBy(*partitions)
    if root:
        writer = writer.option("path", external_path(root, name))
    writer.saveAsTable(name)


# The mode is a setting of the session: writers of this process take turns with it.
_overwriting = threading.RLock()


@contextmanager
def partition_overwrite(spark: SparkSession, mode: str) -> Iterator[None]:
    key = "spark.sql.sources.partitionOverwriteMode"
    with _overwriting:
        before = spark.conf.get(key)
        spark.conf.set(key, mode)
        try:
            yield
        finally:
            spark.conf.set(key, before)


def replace_partitions(df: DataFrame, table: str) -> None:
    """Overwrite just the partitions of a stored table that ``df`` has rows for.

    ``df`` may read from the table itself.
    """
    spark = df.sparkSession
    with partition_overwrite(spark, "dynamic"):
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


def clear_partition(spark: SparkSession, table: str, values: Mapping[str, object]) -> None:
    """Leave a partition of a stored table without rows.

    Its files go even where the table is external; only a partition whose value is
    null, which cannot be overwritten by name, is dropped from the catalog instead.
    """

    def literal(value: object) -> str:
        text = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return "NULL" if value is None else f"'{text}'"

    types = dict(spark.table(table).dtypes)
    named = ", ".join(f"`{c}` = {literal(v)}" for c, v in values.items())
    if None in values.values():
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({named})")
        return
    rest = ", ".join(f"CAST(NULL AS {t}) AS `{c}`" for c, t in types.items() if c not in values)
    with partition_overwrite(spark, "static"):
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({named}) SELECT {rest} WHERE false")


def stored_as(spark: SparkSession, name: str) -> tuple[str, list[str]]:
    """The format a table is stored in, and its partition columns."""
    provider, partitions, listed = "", [], False
    for column, value, _ in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
        if column == "# Partition Information":
            listed = True
        elif listed and not column.startswith("#"):
            listed = bool(column)
            partitions += [column] if column else []
        elif column == "Provider":
            provider = value.lower()
    return provider, partitions


def view_of(table: str, view_name: str | None = None) -> str:
    *qualifier, short = table.split(".")
    return ".".join([*qualifier, view_name or f"{short}_view"])


def publish_view(
    spark: SparkSession, table: str, view_name: str | None = None
) -> str:
    """Create or replace a view over a table, by default ``{table}_view``."""
    view = view_of(table, view_name)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table}")
    return view

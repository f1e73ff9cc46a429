"""Scans of file sets and catalog tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The accepted source formats.
FORMATS = ("csv", "parquet", "json", "delta")


def check_format(name: str) -> str:
    """The format in lower case; an unknown one is an error."""
    if name.lower() not in FORMATS:
        raise ValueError(f"unsupported file format {name!r}, expected one of {FORMATS}")
    return name.lower()


def scan_files(
    spark: SparkSession,
    path: str | list[str],
    file_format: str = "csv",
    options: Mapping[str, Any] | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Read a file, folder or glob. Options apply to CSV only.

    Give a ``schema`` for large text sources: inferring one reads every byte
    once more. A CSV header is then checked against it, so that columns in
    another order fail instead of being read into the wrong names.
    """
    file_format = check_format(file_format)
    reader = spark.read.format(file_format)
    if file_format == "csv":
        reader = reader.options(**(options or {}))
        if schema is not None and "enforceSchema" not in (options or {}):
            reader = reader.option("enforceSchema", "false")
    if schema is not None and file_format != "delta":
        reader = reader.schema(schema)
    return reader.load(path)


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files of a folder or glob; their content is not read."""
    return spark.read.format("binaryFile").load(path).select(
        "path",
        F.col("_metadata.file_path").alias("file"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("size"),
    )


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Read a catalog table, ``database.table`` or ``catalog.schema.table``."""
    return spark.table(name)


def load_window(
    spark: SparkSession,
    path: str | list[str],
    start: datetime | date | str,
    end: datetime | date | str,
    schema: StructType | str | None = None,
    time_column: str = "timestamp",
    file_format: str = "csv",
) -> DataFrame:
    """Rows of all files whose time lies in the window, both ends included.

    The condition is a plain range on a source column, so the scan applies it.
    """
    options = {"header": "true"}
    if schema is None:
        options["inferSchema"] = "true"
    df = scan_files(spark, path, file_format, options, schema)
    return df.where(in_window(df, time_column, start, end))


def window_bounds(data_type: str, start, end):
    """Both ends of a window, typed like the column."""
    return tuple(
        F.lit(v.isoformat(sep=" ") if isinstance(v, datetime) else str(v)).cast(data_type)
        for v in (start, end)
    )


def in_window(df: DataFrame, column: str, start, end):
    """Closed range condition, typed like the column."""
    return F.col(column).between(*window_bounds(dict(df.dtypes)[column], start, end))

"""Layer jobs: ingest (bronze), validate (silver), report (gold).

Each takes a plain dict with the keys ``source``, ``transform``,
``destination`` and optionally ``audit``, and runs as one write job. Row counts
and quality figures are observed in the tasks of the final stage, whose results
count once even when tasks or executors are lost. What cannot be observed there
is counted by a query of its own instead.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tierflow.audit import Audit
from tierflow.operators.columns import (
    add_custom_columns,
    add_metadata_columns,
    rename_columns_to_lowercase,
    rename_columns_to_uppercase,
    standardize_columns,
)
from tierflow.operators.dedupe import remove_duplicates
from tierflow.operators.metrics import add_grain, add_report_metadata, calculate_metrics
from tierflow.operators.observe import Watch
from tierflow.operators.quality import Expectations, add_rule_results
from tierflow.sinks.tables import derive_partitions, publish_view, rebalance, save_table, view_of
from tierflow.sources.files import list_files, scan_files, scan_table
from tierflow.staging import staged
from tierflow.streaming.ingest import Ingested, ingest_new_files

log = logging.getLogger(__name__)

Spec = Mapping[str, Any]


@dataclass(frozen=True)
class LayerResult:
    """What a layer run wrote."""

    table: str
    source_count: int
    target_count: int
    quality: DataFrame | None = None
    view: str | None = None


@contextmanager
def _recorded(spark: SparkSession, layer: str, spec: Spec) -> Iterator[Audit]:
    audit = Audit(spark, layer, spec.get("audit"))
    try:
        yield audit
    except Exception as error:
        log.error("%s failed: %s", layer, error)
        audit.log_error(error)
        audit.log_run(audit.source_count, None, "FAILED")
        raise


def _table_name(section: Spec, default_database: str = "default") -> str:
    return f"{section.get('database', default_database)}.{section['table']}"


def _destination(spec: Spec) -> str:
    """Own database of the destination, else that of the source."""
    source_database = spec.get("source", {}).get("database", "default")
    return _table_name(spec["destination"], source_database)


def _ensure_database(spark: SparkSession, table: str) -> None:
    database = table.rsplit(".", 1)[0]
    if not spark.catalog.databaseExists(database):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def _gathered(df: DataFrame, spec: Spec, time_column: str) -> DataFrame | None:
    """Rows brought together by the partitions they will be written to, or None.

    For the place before checks: what follows is narrow, so that figures can be
    observed. It is left to the write where the partitions cannot be told yet.
    """
    partitions = spec["destination"].get("partitions") or []
    if not partitions or not spec["destination"].get("rebalance", True):
        return df
    try:
        derived = derive_partitions(df, partitions, time_column)
    except ValueError:
        return None
    marks = {f"__partition_{i}": F.col(f"`{p}`") for i, p in enumerate(partitions)}
    held = derived.withColumns(marks).select(*df.columns, *marks)
    return rebalance(held, list(marks)).drop(*marks)


def _write(
    spark: SparkSession, df: DataFrame, spec: Spec, time_column: str, gathered: bool = False
) -> Watch:
    """Save a layer's table as its destination asks; return the watched rows.

    Rows are rebalanced by partition first, unless they are ``gathered`` already
    or ``destination.rebalance`` is false.
    """
    destination = spec["destination"]
    partitions = destination.get("partitions") or []
    table = _destination(spec)
    df = derive_partitions(df, partitions, time_column)
    if destination.get("rebalance", True) and not gathered:
        df = rebalance(df, partitions)
    target = Watch.rows(df)
    _ensure_database(spark, table)
    save_table(
        target.df,
        table,
        destination.get("write_mode", "overwrite"),
        destination.get("format", "parquet"),
        partitions,
        destination.get("root"),
        destination.get("merge_schema", True),
        destination.get("at_once", False),
    )
    return target


# --- bronze ----------------------------------------------------------------


def bronze_scan(spark: SparkSession, spec: Spec) -> DataFrame:
    source = spec["source"]
    return scan_files(
        spark,
        source["path"],
        source.get("format", "csv"),
        source.get("options"),
        source.get("schema"),
    )


def bronze_metadata(df: DataFrame, spec: Spec) -> DataFrame:
    wanted = spec.get("transform", {}).get("add_metadata_columns") or []
    return add_metadata_columns(df, wanted, "BRONZE")


def bronze_transform(df: DataFrame, spec: Spec) -> DataFrame:
    """Metadata columns, then duplicates, then the case of names.

    Metadata comes first, so equal rows of different files stay apart when
    ``source_file`` is among it.
    """
    return bronze_cleaned(bronze_metadata(df, spec), spec)


def bronze_cleaned(df: DataFrame, spec: Spec) -> DataFrame:
    transform = spec.get("transform", {})
    if transform.get("remove_duplicates"):
        df = remove_duplicates(df)
    match transform.get("column_case", "as_is"):
        case "lowercase":
            df = rename_columns_to_lowercase(df)
        case "uppercase":
            df = rename_columns_to_uppercase(df)
    return df


def _ingest_increment(spark: SparkSession, spec: Spec) -> Ingested:
    source, destination = spec["source"], spec["destination"]
    transform = spec.get("transform", {})
    table, partitions = _destination(spec), destination.get("partitions") or []
    time_column = transform.get("time_column", "load_timestamp")
    _ensure_database(spark, table)
    return ingest_new_files(
        spark,
        source["path"],
        table,
        source["schema"],
        source.get("format", "csv"),
        source.get("options"),
        lambda df: derive_partitions(bronze_transform(df, spec), partitions, time_column),
        destination.get("keys"),
        transform.get("duplicates_order"),
        partition_by=partitions,
        root=destination.get("root"),
        max_files_per_batch=source.get("max_files_per_batch"),
        table_format=destination.get("format", "parquet"),
        merge_schema=destination.get("merge_schema", True),
        max_bytes_per_batch=source.get("max_bytes_per_batch"),
        distinct_on=_told_apart_by if _dedupes_across_runs(transform) else None,
    )


# Metadata that says when a row was loaded, which does not make it another row.
RUN_METADATA = {"load_timestamp", "load_date", "load_run_id", "processed_at"}


def _told_apart_by(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c.lower() not in RUN_METADATA]


def _dedupes_across_runs(transform: Spec) -> bool:
    """Rows with an id of their own are never duplicates."""
    wanted = transform.get("add_metadata_columns") or []
    return bool(transform.get("remove_duplicates")) and "record_id" not in wanted


def run_bronze(spark: SparkSession, spec: Spec) -> LayerResult:
    """Ingest files into the bronze table.

    With ``source.incremental`` only files that are new or have changed are read.
    Their rows are upserted if ``destination.keys`` is given, by the order
    ``transform.duplicates_order`` where a file repeats a key, and added otherwise;
    with ``transform.remove_duplicates`` rows that earlier runs added are left out,
    so the table is that of one run over all files.
    """
    with _recorded(spark, "BRONZE", spec) as audit:
        transform = spec.get("transform", {})
        if spec["source"].get("incremental"):
            ingested = _ingest_increment(spark, spec)
            audit.log_run(ingested.source_count, ingested.target_count)
            return LayerResult(
                _destination(spec), ingested.source_count, ingested.target_count
            )
        scan = bronze_metadata(bronze_scan(spark, spec), spec)
        destination, time_column = spec["destination"], transform.get("time_column", "load_timestamp")
        shuffles = transform.get("remove_duplicates") or (
            destination.get("partitions") and destination.get("rebalance", True)
        )
        if shuffles:
            # Parsed once; its rows are counted from the footers of what was stored.
            with staged(scan, "bronze") as rows:
                source_count = audit.source_count = rows.count()
                target = _write(spark, bronze_cleaned(rows, spec), spec, time_column)
                written = target.row_count
        else:
            watched = Watch.rows(scan)
            written = _write(spark, bronze_cleaned(watched.df, spec), spec, time_column).row_count
            source_count = watched.row_count
        audit.log_run(source_count, written)
        return LayerResult(_destination(spec), source_count, written)


# --- silver ----------------------------------------------------------------


@dataclass
class _Checks:
    """A table under validation and the figures being taken of it."""

    expectations: Expectations
    watch: Watch | None
    checked: DataFrame

    @classmethod
    def on(cls, df: DataFrame, expectations: Expectations, observe: bool) -> _Checks:
        watch = Watch(df, expectations.metrics) if observe else None
        return cls(expectations, watch, watch.df if watch else df)

    def report(self, spark: SparkSession) -> DataFrame:
        if self.watch is None:
            return self.expectations.report(self.checked.agg(*self.expectations.metrics))
        return self.expectations.report_observed(spark, self.watch.values)


def silver_transform(
    df: DataFrame,
    spec: Spec,
    observe: bool = True,
    gather: Callable[[DataFrame], DataFrame | None] = lambda df: df,
) -> tuple[DataFrame, list[_Checks]]:
    """Duplicates, quality checks, standardization, business rules, own columns."""
    transform = spec.get("transform", {})
    checks: list[_Checks] = []

    def enabled(section: str) -> Spec | None:
        settings = transform.get(section) or {}
        return settings if settings.get("enabled") else None

    def check(df: DataFrame, expectations: Expectations) -> DataFrame:
        checks.append(_Checks.on(df, expectations, observe))
        return checks[-1].checked

    if settings := enabled("deduplication"):
        df = remove_duplicates(df, settings.get("subset"))
    gathered = gather(df)
    if gathered is None:
        observe = False
    else:
        df = gathered
    if settings := enabled("quality_checks"):
        df = check(df, Expectations(df, settings.get("rules", {})))
    if settings := enabled("standardization"):
        df = standardize_columns(
            df,
            settings.get("trim_strings", False),
            settings.get("lowercase", False),
            settings.get("remove_special_chars", False),
        )
    if settings := enabled("business_rules"):
        rules = settings.get("rules", [])
        df = check(df, Expectations(df, business_rules=rules, table_lines=False))
        df = add_rule_results(df, rules)
    df = add_custom_columns(df, transform.get("custom_columns") or {})
    return df, checks


def run_silver(spark: SparkSession, spec: Spec) -> LayerResult:
    """Validate and clean the bronze table into the silver table.

    Checks report, they never drop rows. The report is returned, and stored
    when ``transform.quality_checks.report_table`` names a table.
    """
    with _recorded(spark, "SILVER", spec) as audit:
        transform = spec.get("transform", {})
        source = scan_table(spark, _table_name(spec["source"]))
        source_count = audit.source_count = source.count()
        time_column, placed = transform.get("time_column", "load_timestamp"), []

        def gather(df: DataFrame) -> DataFrame | None:
            placed.append(_gathered(df, spec, time_column))
            return placed[0]

        df, checks = silver_transform(source, spec, gather=gather)
        target = _write(spark, df, spec, time_column, gathered=placed[0] is not None)

        quality = None
        for part in checks:
            report = part.report(spark)
            quality = report if quality is None else quality.unionByName(report)
        if quality is not None:
            for line in quality.where(~F.col("passed")).collect():
                log.warning("rule not met: %s", line.asDict())
            report_table = (transform.get("quality_checks") or {}).get("report_table")
            if report_table:
                _ensure_database(spark, report_table)
                quality.coalesce(1).write.mode("append").saveAsTable(report_table)

        audit.log_run(source_count, target.row_count)
        return LayerResult(_destination(spec), source_count, target.row_count, quality)


# --- gold ------------------------------------------------------------------


def gold_transform(df: DataFrame, spec: Spec) -> DataFrame:
    """Own dimensions, grain, metrics, report metadata."""
    transform = spec.get("transform", {})
    df = add_custom_columns(df, transform.get("custom_dimensions") or {})
    df = add_grain(
        df,
        transform.get("aggregation_grain", "daily"),
        transform.get("time_column", "load_timestamp"),
    )
    df = calculate_metrics(
        df, transform.get("metrics") or {}, transform.get("dimensions") or []
    )
    return add_report_metadata(df)


def run_gold(spark: SparkSession, spec: Spec) -> LayerResult:
    """Aggregate the silver table into the gold table and publish its view."""
    with _recorded(spark, "GOLD", spec) as audit:
        destination = spec["destination"]
        source = scan_table(spark, _table_name(spec["source"]))
        source_count = audit.source_count = source.count()
        df = gold_transform(source, spec)
        time_column = "agg_date" if "agg_date" in df.columns else "report_generated_at"
        target = _write(spark, df, spec, time_column)
        table, view = _destination(spec), None
        if destination.get("create_view"):
            view = publish_view(spark, table, destination.get("view_name"))
        audit.log_run(source_count, target.row_count)
        return LayerResult(table, source_count, target.row_count, view=view)


# --- all -------------------------------------------------------------------


def source_version(spark: SparkSession, spec: Spec) -> str:
    """What the files of a bronze source are: their number, and a sum over names, times and sizes."""
    files = list_files(spark, spec["source"]["path"])
    state = F.xxhash64("file", "modified", "size").cast("decimal(38,0)")
    n, total = files.agg(F.count("*"), F.sum(state)).first()
    return f"{n}:{total or 0}"


def _with_audit(spec: Spec, **values: str) -> Spec:
    return {**spec, "audit": {**(spec.get("audit") or {}), **values}}


def run_layers(
    spark: SparkSession, bronze: Spec, silver: Spec, gold: Spec, job_id: str | None = None
) -> tuple[LayerResult, LayerResult, LayerResult]:
    """Bronze, silver and gold in turn; a failure stops the run.

    With a ``job_id`` a run that failed can be run again: the audit table says which
    layers the same job has finished on the same source, and those are not run
    again. Bronze knows its source by its files, a later layer by the run of the
    layer before, so all that follows a layer that is run again is run again, too.
    """
    steps = [("BRONZE", bronze, run_bronze), ("SILVER", silver, run_silver), ("GOLD", gold, run_gold)]
    if job_id is None:
        return tuple(run(spark, spec) for _, spec, run in steps)
    results, version = [], source_version(spark, bronze)
    for layer, spec, run in steps:
        spec = _with_audit(spec, job_id=job_id, source_version=version)
        done = Audit(spark, layer, spec["audit"]).completed()
        if done is None:
            results.append(run(spark, spec))
            done = Audit(spark, layer, spec["audit"]).completed()
        else:
            log.info("%s of job %s is complete", layer, job_id)
            results.append(_earlier(spec, done))
        version = done.run_id
    return tuple(results)


def _earlier(spec: Spec, run: Row) -> LayerResult:
    """What a finished run had returned, without its report."""
    table, destination = _destination(spec), spec["destination"]
    view = None
    if destination.get("create_view"):
        view = view_of(table, destination.get("view_name"))
    return LayerResult(table, run.source_count, run.target_count, view=view)

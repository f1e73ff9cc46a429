"""Audit and error tables: one appended row per layer run or failure."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

from tierflow.sinks.tables import save_table, table_exists

# Table names used unless the specification names others.
AUDIT_TABLE = "pipeline_audit"
ERROR_TABLE = "pipeline_errors"

AUDIT_SCHEMA = (
    "run_id string, layer string, source_count long, target_count long, "
    "status string, started_at timestamp, ended_at timestamp, "
    "job_id string, source_version string"
)
ERROR_SCHEMA = (
    "run_id string, layer string, error_type string, message string, failed_at timestamp"
)


class Audit:
    """Writes to the audit and error tables of one run of one layer."""

    def __init__(
        self,
        spark: SparkSession,
        layer: str,
        spec: Mapping[str, str] | None = None,
    ):
        spec = spec or {}
        self._spark = spark
        self._layer = layer
        self.audit_table = spec.get("audit_table", AUDIT_TABLE)
        self.error_table = spec.get("error_table", ERROR_TABLE)
        self.run_id = uuid.uuid4().hex
        # What a job that is run again is known by, and what it had read.
        self.job_id, self.source_version = spec.get("job_id"), spec.get("source_version")
        # Known to a failed run as well, once it has been counted.
        self.source_count: int | None = None
        self._started = datetime.now(timezone.utc)

    def log_run(
        self, source_count: int | None, target_count: int | None, status: str = "SUCCESS"
    ) -> None:
        row = (
            self.run_id, self._layer, source_count, target_count, status,
            self._started, datetime.now(timezone.utc), self.job_id, self.source_version,
        )
        self._append(self.audit_table, AUDIT_SCHEMA, row)

    def log_error(self, error: BaseException) -> None:
        row = (
            self.run_id, self._layer, type(error).__name__, str(error),
            datetime.now(timezone.utc),
        )
        self._append(self.error_table, ERROR_SCHEMA, row)

    def completed(self) -> Row | None:
        """The run of this layer that the same job has finished on the same source, if any."""
        if self.job_id is None or not table_exists(self._spark, self.audit_table):
            return None
        runs = self._spark.table(self.audit_table)
        if "job_id" not in runs.columns:
            return None
        found = runs.where(
            (F.col("job_id") == self.job_id)
            & (F.col("layer") == self._layer)
            & (F.col("status") == "SUCCESS")
            & (F.col("source_version") == self.source_version)
        )
        return found.orderBy(F.desc("ended_at")).first()

    def _append(self, table: str, schema: str, row: tuple) -> None:
        # Tables of earlier times gain the columns they lack.
        rows = self._spark.createDataFrame([row], schema).coalesce(1)
        save_table(rows, table, "append")

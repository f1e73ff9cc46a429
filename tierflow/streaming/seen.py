"""An index of the rows that a table has taken in, to know them when they come again.

Each row that a file delivered has an entry with two hashes of 64 bits, the file,
the batch, and whether the table kept the row or had it from another file. The
index is bucketed by hash, so looking rows up shuffles the new rows alone. A
match counts once the whole rows are equal, so hashes never decide.

Entries are only added. Those of a file's earlier states, and of batches that
were not finished, are passed over by what the ledger says. When a file changes,
the files whose rows were left out for its sake are named, to be read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.sinks.tables import table_exists
from tierflow.staging import stage

HASHES = ["row_hash", "row_check"]
BUCKETS = 32


def row_hashes(columns: Sequence[str]) -> list[Column]:
    """Two hashes of the columns; a null is not the absence of a column."""
    parts = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return [F.xxhash64(F.lit(seed), *parts).alias(name) for seed, name in enumerate(HASHES)]


def same_rows(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """Join on equality of ``columns``, null with null; the left columns alone stay."""
    other = right.select(*[F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(columns)])
    equal = [F.col(f"`{c}`").eqNullSafe(F.col(f"__{i}")) for i, c in enumerate(columns)]
    return left.join(other, reduce(and_, equal), how)


class RowIndex:
    def __init__(self, spark: SparkSession, table: str, ledger: str, file: str, batch: str):
        self.spark, self.table, self.ledger = spark, table, ledger
        self.file, self.batch, self.name = file, batch, f"{table}__row_hashes"

    def clear(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def exists(self) -> bool:
        return table_exists(self.spark, self.name)

    def entries(self) -> DataFrame:
        """Entries that hold for the table as it is."""
        states = self.spark.table(self.ledger).groupBy("file", "batch").agg(F.max("done").alias("done"))
        newest = F.max(F.when(F.col("done"), F.col("batch"))).over(Window.partitionBy("file"))
        # Few: earlier states of files that have changed, and what broke off.
        void = states.withColumn("newest", newest).where("NOT done OR newest > batch")
        return self.spark.table(self.name).join(void.select("file", "batch"), ["file", "batch"], "left_anti")

    def dependents(self, files: DataFrame) -> DataFrame:
        """Files with rows that were left out because one of ``files`` (``file``) had them."""
        entries = self.entries()
        held = entries.where("kept").join(files, "file", "left_semi").select(*HASHES)
        left_out = entries.where("NOT kept").join(held, HASHES, "left_semi")
        return left_out.select("file").distinct().join(files, "file", "left_anti")

    def unseen(self, rows: DataFrame, columns: Sequence[str], batch: int) -> tuple[DataFrame, DataFrame]:
        """Of the stored ``rows`` of a batch those that the table lacks, one of each;
        and the entries of all of them.

        Of equal rows of one batch the one of the first file, by name, stays. Files
        of this batch replace their own earlier states, which therefore do not count.
        """
        hashed = rows.select("*", *row_hashes(columns))
        whole = [*HASHES, *[F.col(f"`{c}`") for c in columns]]
        nth = F.row_number().over(Window.partitionBy(*whole).orderBy(self.file))
        ranked, _ = stage(hashed.withColumn("__nth", nth), "hashed")
        first = ranked.where("__nth = 1").drop("__nth")
        fresh = first
        if self.exists():
            mine = rows.select(F.col(self.file).alias("file")).distinct()
            known = self.entries().where("kept").join(mine, "file", "left_anti")
            found, _ = stage(
                first.join(known.select(*HASHES, F.col("batch").alias("__batch")), HASHES), "found"
            )
            batches = [r[0] for r in found.select("__batch").distinct().collect()]
            if batches:
                held = self.spark.table(self.table).where(F.col(self.batch).isin(batches))
                again, _ = stage(same_rows(found, held, columns, "left_semi").drop("__batch"), "again")
                fresh, _ = stage(same_rows(first, again, [*HASHES, *columns], "left_anti"), "fresh")
        kept = fresh.select(*HASHES, F.col(self.file).alias("file"), F.lit(True).alias("kept"))
        every = ranked.select(*HASHES, F.col(self.file).alias("file")).distinct()
        entries = every.join(kept, [*HASHES, "file"], "left").select(
            *HASHES, "file", F.lit(batch).cast("long").alias("batch"), F.coalesce("kept", F.lit(False)).alias("kept")
        )
        return fresh.drop(*HASHES), entries

    def add(self, entries: DataFrame) -> None:
        dealt = entries.repartition(BUCKETS, "row_hash")
        dealt.write.bucketBy(BUCKETS, "row_hash").sortBy("row_hash").mode("append").saveAsTable(self.name)

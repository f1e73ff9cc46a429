"""A lasting mapping of values to tokens, to tokenize by and to restore from.

A mapping table holds each value it has met once, with its token. It only grows:
a value keeps the token it was first given, whatever the salt later is. A token
that would stand for two values is an error, found before anything is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.protect import create_token_mapping
from tierflow.sinks.snapshots import compact_table
from tierflow.sinks.tables import save_table, table_exists
from tierflow.staging import staged


class TokenMapping:
    """The mapping of one column, as the table ``table`` of ``column`` and ``{column}_token``."""

    def __init__(self, spark: SparkSession, table: str, column: str, salt: str = ""):
        self.spark, self.table, self.column, self.salt = spark, table, column, salt
        self.token = f"{column}_token"

    def extend(self, df: DataFrame) -> int:
        """Enter the values of ``df`` that are new, null among them; returns how many were."""
        fresh = create_token_mapping(df, self.column, self.salt)
        held = self.spark.table(self.table) if table_exists(self.spark, self.table) else None
        if held is not None:
            fresh = self._matched(fresh, held.select(self.column), "left_anti")
        with staged(fresh, "tokens") as new:
            tokens = new.select(self.token)
            if held is not None:
                # Of what is stored only tokens that come again take part.
                tokens = tokens.union(held.select(self.token).join(tokens, self.token, "left_semi"))
            shared = tokens.groupBy(self.token).count().where("count > 1").limit(1).collect()
            if shared:
                raise ValueError(f"token {shared[0][0]} would stand for several values of {self.column}")
            added = new.count()
            if added:
                save_table(new, self.table, "append")
                compact_table(self.spark, self.table)
        return added

    def tokenize(self, df: DataFrame, keep: bool = False) -> DataFrame:
        """Put ``{column}_token`` in place of the column, or beside it; null where it is not mapped."""
        result = self._matched(df, self.spark.table(self.table), "left")
        return result if keep else result.drop(self.column)

    def restore(self, df: DataFrame) -> DataFrame:
        """Put the column in place of its token; null for a token that is not mapped."""
        return df.join(self.spark.table(self.table), self.token, "left").drop(self.token)

    def _matched(self, df: DataFrame, other: DataFrame, how: str) -> DataFrame:
        """Join on the column, null with null."""
        named = other.withColumnRenamed(self.column, "__value")
        return df.join(named, F.col(f"`{self.column}`").eqNullSafe(F.col("__value")), how).drop("__value")

"""Duplicate removal.

In every form copies collapse within each task before the shuffle: the
aggregates combine partially, and the ranking keeps the first row of each key
per task. However many copies of a row there are, a task sends one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def remove_duplicates(
    df: DataFrame,
    subset: Sequence[str] | None = None,
    order_by: Sequence[Column | str] | None = None,
    null_keys_differ: bool = False,
) -> DataFrame:
    """Keep one row per distinct row, or per distinct value of ``subset``.

    Which row of a group survives is arbitrary unless ``order_by`` is given;
    then it is the first in that order. Rows that tie on it are told apart by
    their other columns, so the survivor never depends on how the table is
    split up. With ``null_keys_differ`` a row with a null in ``subset`` equals no
    other and stays.
    """
    if not subset:
        return df.dropDuplicates()
    if not order_by:
        return df.dropDuplicates(list(subset))
    others = [c for c in df.columns if c not in subset]
    groups = [*subset, own_group(subset)] if null_keys_differ else list(subset)
    first = Window.partitionBy(*groups).orderBy(*order_by, *others)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def own_group(keys: Sequence[str]) -> Column:
    """Null for rows that have all keys; a number of its own for any other.

    Beside the keys of a grouping it keeps rows with null keys apart, and spreads
    them over all tasks, in the same pass as the others.
    """
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return F.when(~complete, F.monotonically_increasing_id())


def duplicate_counts(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows before and after duplicate removal, and rows removed, in one pass."""
    groups = df.groupBy(*(subset or df.columns)).agg(F.count(F.lit(1)).alias("_copies"))
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("source_count"),
        F.count(F.lit(1)).alias("target_count"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("removed_count"),
    )

"""Deliveries of the ingest queries: many files, the rows of all of them."""

import pytest
from pyspark.sql import functions as F

from support import explained, rows
from tierflow.plans import queries
from tierflow.sinks import snapshots
from tierflow.sinks.upsert import check_unique, repeated_keys
from tierflow.staging import children, stage, staged
from tierflow.streaming import ingest
from tierflow.streaming.ingest import FILE_COLUMN, TIME_COLUMN, newest_per_key

N = 4000


@pytest.fixture
def folder(spark, tmp_path, monkeypatch):
    """Events of its own, of which each file of a delivery has a part."""
    events = spark.range(N).select(
        F.when(F.col("id") < N - 1, F.col("id")).alias("event_id"),
        F.concat(F.lit("type"), F.col("id") % 3).alias("event_type"),
        (F.col("id") / 7).alias("value"),
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(queries, "DELIVERED_BYTES", 4000)
    return str(tmp_path)


def test_a_delivery_has_files_of_bounded_size(spark, folder):
    events = queries.table(spark, folder, "events")
    path = f"{folder}/inbox"
    queries.deliver(events.union(events), path, "twice")
    found = spark.read.parquet(f"{path}/twice.parquet").withColumn("file", F.col("_metadata.file_name"))
    per_file = found.groupBy("file").count().collect()
    assert len(per_file) > 4 and max(r["count"] for r in per_file) < N
    copies = found.groupBy("event_id").agg(F.countDistinct("file").alias("files"), F.count("*").alias("n"))
    assert copies.where("files <> 1 OR n <> 2").count() == 0
    before = {f.rpartition("/")[2] for f in children(spark, f"{path}/twice.parquet")}
    queries.deliver(events, path, "twice")
    assert {f.rpartition("/")[2] for f in children(spark, f"{path}/twice.parquet")} == before
    assert rows(spark.read.parquet(f"{path}/*")) == rows(events)


def test_a_delivery_leaves_no_file_of_an_earlier_one(spark, folder):
    events = queries.table(spark, folder, "events")
    queries.deliver(events, f"{folder}/inbox", "a")
    queries.deliver(events.where("event_id = 5"), f"{folder}/inbox", "a")
    assert [r[0] for r in rows(spark.read.parquet(f"{folder}/inbox/*"))] == [5]


def test_audit_of_many_files(spark, folder):
    found = queries.QUERIES["ingest_audit"](spark, folder)
    assert rows(found) == [("BRONZE", 2 * N, N, "SUCCESS")]


def test_redelivery_of_many_files(spark, folder):
    found = queries.QUERIES["ingest_redelivered"](spark, folder).where("event_id IS NOT NULL")
    assert rows(found) == rows(queries.table(spark, folder, "events").where("event_id IS NOT NULL"))


@pytest.mark.parametrize("name", ["ingest_two_sources", "ingest_updated_file"])
def test_unkeyed_files(spark, folder, name):
    found = queries.QUERIES[name](spark, folder)
    expected = queries.table(spark, folder, "events").where("event_id IS NOT NULL")
    assert rows(found) == rows(expected, "event_id", "event_type")


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(snapshots, "PART_BYTES", 1000)


def test_files_of_a_run_are_dealt_by_their_size_and_sorted_once(spark, small_parts):
    delivered = spark.createDataFrame(
        [
            (1, "old", "b", 1), (1, "new", "a", 2), (1, "copy", "a", 2), (2, "tie", "a", 2), (2, "last", "b", 2),
            (3, "alone", "b", 1), (None, "x", "b", 1), (None, "y", "a", 2), (None, "y", "a", 2),
        ],
        f"id long, text string, {FILE_COLUMN} string, {TIME_COLUMN} int",
    )
    expected = [
        (1, "copy"), (1, "new"), (2, "last"), (3, "alone"), (None, "x"), (None, "y"), (None, "y"),
    ]
    for size, parts in ((0, 1), (999, 1), (6500, 7)):
        newest = newest_per_key(delivered, ["id"], size)
        assert newest.columns == delivered.columns
        assert rows(newest, "id", "text") == expected
        assert explained(newest).count("Sort (") == 1
        assert newest.rdd.getNumPartitions() == parts
    assert rows(newest_per_key(delivered, ["id"]), "id", "text") == expected
    assert rows(newest_per_key(delivered.limit(0), ["id"], 0)) == []


def test_an_ingest_with_keys_sorts_no_rows_where_it_reads_them(spark, folder, small_parts, monkeypatch):
    plans = []

    def recorded(df, label):
        plans.append(explained(df))
        return staged(df, label)

    monkeypatch.setattr(ingest, "staged", recorded)
    found = queries.QUERIES["ingest_redelivered"](spark, folder).where("event_id IS NOT NULL")
    assert rows(found) == rows(queries.table(spark, folder, "events").where("event_id IS NOT NULL"))
    assert len(plans) == 1 and "REPARTITION_BY_NUM" in plans[0]
    assert plans[0].count("Sort (") == plans[0].count("Exchange (") == 1


def test_rows_of_a_task_do_not_grow_with_the_files_of_a_run(spark, folder, small_parts):
    events = queries.table(spark, folder, "events").select("event_id", "value")
    delivered = events.withColumns({FILE_COLUMN: F.lit("a"), TIME_COLUMN: F.lit(1)})
    most = []
    for copies in (1, 8):
        many = delivered.crossJoin(spark.range(copies)).withColumn("event_id", F.expr("event_id * 8 + id"))
        found = newest_per_key(many.where("event_id IS NOT NULL"), ["event_id"], 6500 * copies)
        most.append(max(r[1] for r in found.groupBy(F.spark_partition_id()).count().collect()))
    assert most[1] < 1.3 * most[0]


def test_repeated_keys_of_stored_rows_are_found_in_parts_of_their_size(spark, small_parts):
    once = spark.range(N).select(F.when(F.col("id") > 0, F.col("id")).alias("a"), F.lit("x").alias("b"))
    nulls = spark.range(5).select(F.lit(None).cast("long").alias("a"), F.lit("x").alias("b"))
    stored, _ = stage(once.union(nulls), "once")
    parts = snapshots.parts_for(snapshots.stored_bytes(stored))
    assert parts > 4
    assert f", {parts}), REPARTITION_BY_NUM" in explained(repeated_keys(stored, ["a", "b"]))
    check_unique(stored, ["a", "b"])
    twice, _ = stage(once.union(once.where("a = 7 OR a IS NULL")), "twice")
    assert rows(repeated_keys(twice, ["a", "b"])) == [(7, "x", 2)]
    for found in (twice, once.union(once)):
        with pytest.raises(ValueError, match="several source rows share one key"):
            check_unique(found, ["a", "b"])


def test_the_number_of_parts_is_bounded():
    assert snapshots.parts_for(0) == 1
    assert snapshots.parts_for(snapshots.PART_BYTES * 3) == 4
    assert snapshots.parts_for(1 << 60) == snapshots.MOST_PARTS

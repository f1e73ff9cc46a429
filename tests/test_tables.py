from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from support import rows
from tierflow.operators import timeseries
from tierflow.sinks import tables, upsert as ups
from tierflow.sources.files import load_window, scan_files
from tierflow.staging import new_path

TARGET = [(1, "a", 1), (2, "b", 1), (3, "c", 2)]
SOURCE = [(3, "C", 2), (4, "D", 2)]
MERGED = [(1, "a", 1), (2, "b", 1), (3, "C", 2), (4, "D", 2)]


def keyed(spark, data):
    return spark.createDataFrame(data, "id int, v string, p int")


def files(spark, name):
    """Data files of a table, as partition/file."""
    paths = {urlparse(r[0]).path for r in spark.table(name).select(F.input_file_name()).collect()}
    return {"/".join(Path(p).parts[-2:]) for p in paths}


# --- sources ---------------------------------------------------------------


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="xml"):
        scan_files(spark, "/nowhere", "xml")


def test_csv_options_and_case_of_format(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('a,b\n1,"x ""y""\nz"\n')
    options = {"header": True, "inferSchema": True, "multiLine": True, "escape": '"'}
    df = scan_files(spark, str(path), "CSV", options)
    assert rows(df) == [(1, 'x "y"\nz')]


def test_csv_header_is_checked_against_the_schema(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        scan_files(spark, str(path), "csv", {"header": True}, "a int, b int").collect()


def test_window_load_is_closed_and_reads_all_files(spark, tmp_path):
    (tmp_path / "g1.csv").write_text(
        "timestamp,turbine_id,power_output\n2024-01-01 00:00:00,1,1.5\n2024-01-03 00:00:00,1,2.5\n"
    )
    (tmp_path / "g2.csv").write_text(
        "timestamp,turbine_id,power_output\n2024-01-02 00:00:00,2,3.5\n2024-01-03 00:00:01,2,4.5\n"
    )
    df = load_window(spark, f"{tmp_path}/*.csv", "2024-01-01", "2024-01-03")
    assert dict(df.dtypes)["timestamp"] == "timestamp"
    assert rows(df, "power_output") == [(1.5,), (2.5,), (3.5,)]


# --- saves -----------------------------------------------------------------


def test_modes_and_evolving_columns(spark, database):
    name, df = f"{database}.t", keyed(spark, TARGET)
    tables.save_table(df, name)
    tables.save_table(df.drop("v").withColumn("w", F.lit(9)), name, "append")
    assert spark.table(name).columns == ["id", "v", "p", "w"]
    assert spark.table(name).where("w is null").count() == 3
    assert spark.table(name).where("v is null").count() == 3
    tables.save_table(df, name)
    assert spark.table(name).count() == 3 and "w" in spark.table(name).columns


def test_evolving_partitioned_table(spark, database):
    name, df = f"{database}.t", keyed(spark, TARGET)
    tables.save_table(df, name, partitions=["p"])
    tables.save_table(df.withColumn("w", F.lit(9)), name, "append", partitions=["p"])
    assert rows(spark.table(name).groupBy("p", "w").count(), "p", "w", "count") == [
        (1, 9, 2), (1, None, 2), (2, 9, 1), (2, None, 1)]


def test_external_location(spark, database, tmp_path):
    tables.save_table(keyed(spark, TARGET), f"{database}.t", root=str(tmp_path))
    assert (tmp_path / f"{database}.db" / "t" / "_SUCCESS").exists()
    assert spark.table(f"{database}.t").count() == 3


def test_partitions_are_derived(spark):
    df = spark.sql("select timestamp'2024-02-03 10:00:00' as at, 1 as year")
    derived = tables.derive_partitions(df, ["year", "month", "day", "date"], "at").first()
    assert tuple(derived)[1:4] == (1, 2, 3) and str(derived["date"]) == "2024-02-03"
    with pytest.raises(ValueError, match="region"):
        tables.derive_partitions(df, ["region"], "at")
    with pytest.raises(ValueError, match="time column"):
        tables.derive_partitions(df, ["month"], "absent")


def test_view_names(spark, database):
    tables.save_table(keyed(spark, TARGET), f"{database}.t")
    assert tables.publish_view(spark, f"{database}.t") == f"{database}.t_view"
    assert tables.publish_view(spark, f"{database}.t", "v") == f"{database}.v"
    assert spark.table(f"{database}.v").count() == 3


# --- upsert ----------------------------------------------------------------


@pytest.mark.parametrize("partition_by", [[], ["p"], ["p", "v"]])
def test_upsert(spark, database, partition_by):
    name = f"{database}.t"
    source = SOURCE if "v" not in partition_by else [(3, "c", 2), (4, "D", 2)]
    expected = MERGED if "v" not in partition_by else [*TARGET, (4, "D", 2)]
    ups.upsert(spark, keyed(spark, TARGET), name, ["id"], partition_by)
    for _ in range(2):
        ups.upsert(spark, keyed(spark, source), name, ["id"], partition_by)
        assert rows(spark.table(name), "id", "v", "p") == expected


def test_untouched_partitions_keep_their_files(spark, database):
    name = f"{database}.t"
    ups.upsert(spark, keyed(spark, TARGET), name, ["id"], ["p"])
    before = files(spark, name)
    ups.upsert(spark, keyed(spark, SOURCE), name, ["id"], ["p"])
    kept = before & files(spark, name)
    assert {p.split("/")[0] for p in kept} == {"p=1"}


def test_many_partitions_of_two_columns(spark, database):
    """The first and the last are delivered again; all files in between stay."""
    name = f"{database}.t"
    df = spark.range(0, 1200).selectExpr(
        "id", "0 AS v", "id % 300 AS p", "IF(id % 4 = 0, NULL, id % 4) AS q"
    )
    keys, parts = ["id", "p", "q"], ["p", "q"]
    save = df.where("p > 1 OR q IS NOT NULL")
    ups.upsert(spark, save.fillna(-1, "q"), name, keys, parts)
    before = set(spark.table(name).inputFiles())
    later = df.where("p IN (1, 299)").fillna(-1, "q").withColumn("v", F.lit(1))
    ups.upsert(spark, later, name, keys, parts)
    gone = before - set(spark.table(name).inputFiles())
    assert {f.split("/")[-3] for f in gone} == {"p=1", "p=299"}
    assert spark.table(name).where("v = 1").count() == later.count()
    condition = ups.touched_partitions(df, parts)
    assert spark.table(name).where(condition).count() > 0


def test_null_values_in_several_partition_columns(spark, database):
    name = f"{database}.t"
    data = [(1, "a", None), (2, None, 5), (3, None, None), (4, "a", 5)]
    schema = "id int, p string, q int"
    keys = ["id"]
    ups.upsert(spark, spark.createDataFrame(data, schema), name, keys, ["p", "q"])
    again = spark.createDataFrame([(1, "b", 5), (3, None, None), (5, None, 5)], schema)
    ups.upsert(spark, again, name, keys, ["p", "q"])
    assert rows(spark.table(name), "id", "p", "q") == sorted(
        [(1, "b", 5), (2, None, 5), (3, None, None), (4, "a", 5), (5, None, 5)], key=repr)


def test_building_an_operator_starts_no_job(spark):
    readings = spark.sql(
        "SELECT timestamp'2024-01-01' + make_interval(0,0,0,0,CAST(id AS INT)) AS timestamp, 1 AS turbine_id, "
        "1D AS wind_speed, 1D AS wind_direction, 1D AS power_output FROM range(48)")
    root = Path(urlparse(new_path(spark, "x")).path).parent
    before = set(root.glob("*"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        timeseries.process(readings, "2024-01-01", "2024-01-03")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert set(root.glob("*")) == before


def test_a_moved_row_leaves_its_partition(spark, database):
    name = f"{database}.t"
    ups.upsert(spark, keyed(spark, TARGET), name, ["id"], ["p"])
    moved = [(1, "a", 9)]
    ups.upsert(spark, keyed(spark, moved), name, ["id"], ["p"])
    assert spark.table(name).where("id = 1").collect()[0].p == 9
    assert spark.table(name).count() == len(TARGET)


def test_upsert_aligns_columns(spark, database):
    name = f"{database}.t"
    ups.upsert(spark, keyed(spark, TARGET), name, ["id"], ["p"])
    ups.upsert(spark, keyed(spark, [(1, "A", 1)]).withColumn("w", F.lit(7)), name, ["id"], ["p"])
    ups.upsert(spark, keyed(spark, [(8, "x", 1)]).drop("v"), name, ["id"], ["p"])
    assert rows(spark.table(name).where("id IN (1, 8)"), "id", "v", "w") == [(1, "A", 7), (8, None, None)]


def test_a_failed_upsert_leaves_the_table_as_it_was(spark, database):
    name = f"{database}.t"
    ups.upsert(spark, keyed(spark, TARGET), name, ["id"])
    damaged = keyed(spark, SOURCE).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        ups.upsert(spark, damaged, name, ["id"], source_is_stored=True, keys_are_unique=True)
    assert rows(spark.table(name), "id", "v", "p") == rows(keyed(spark, TARGET), "id", "v", "p")


def test_names_follow_the_case_rule(spark, database):
    name = f"{database}.t"
    tables.save_table(keyed(spark, TARGET), name)
    tables.save_table(keyed(spark, TARGET).toDF("ID", "V", "P"), name)
    tables.save_table(keyed(spark, TARGET).toDF("Id", "V", "P"), name, "append")
    assert rows(spark.table(name), "id", "v", "p") == sorted(TARGET * 2)
    clash = keyed(spark, TARGET)
    clash = clash.toDF("id", "v", "p").withColumnRenamed("p", "P").withColumn("q", F.lit(1)).toDF("id", "v", "P", "ID")
    with pytest.raises(ValueError, match="case rule"):
        tables.save_table(clash, name, "append")


def test_only_touched_partitions_are_read(spark, database):
    name = f"{database}.t"
    ups.upsert(spark, keyed(spark, [(i, "a", i) for i in range(9)]), name, ["id"], ["p"])
    condition = ups.touched_partitions(keyed(spark, [(2, "x", 2), (5, "y", 5)]), ["p"])
    read = spark.table(name).where(condition).select(F.input_file_name()).distinct()
    assert {r[0].split("/")[-2] for r in read.collect()} == {"p=2", "p=5"}


def test_duplicate_source_keys(spark, database):
    name = f"{database}.t"
    twice = keyed(spark, [(3, "x", 2), (3, "y", 2)])
    with pytest.raises(ValueError, match="share one key"):
        ups.upsert(spark, twice, name, ["id"], ["p"])
    ups.upsert(spark, keyed(spark, TARGET), name, ["id"], ["p"])
    with pytest.raises(ValueError, match="share one key"):
        ups.upsert(spark, twice, name, ["id"], ["p"])
    assert rows(spark.table(name), "id", "v", "p") == TARGET
    ups.upsert(spark, twice, name, ["id"], ["p"], dedupe_source_on=[F.col("v").desc()])
    assert rows(spark.table(name), "id", "v") == [(1, "a"), (2, "b"), (3, "y")]


def test_null_keys_are_inserted(spark, database):
    name = f"{database}.t"
    ups.upsert(spark, keyed(spark, [(None, "a", 1)]), name, ["id"], ["p"])
    nulls = keyed(spark, [(None, "b", 1), (None, "b", 1)])
    ups.upsert(spark, nulls, name, ["id"], ["p"])
    ups.upsert(spark, nulls, name, ["id"], ["p"], dedupe_source_on=["v"])
    assert [r[0] for r in rows(spark.table(name), "v")] == ["a", "b", "b", "b", "b"]


def test_merge_statement():
    assert ups.merge_statement("c.s.t", "src", ["a", "b"]) == (
        "MERGE INTO c.s.t AS target USING src AS source "
        "ON target.`a` = source.`a` AND target.`b` = source.`b` "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def test_staged_files_are_removed(spark, database):
    root = Path(urlparse(new_path(spark, "x")).path).parent
    before = set(root.glob("upsert-*"))
    ups.upsert(spark, keyed(spark, TARGET), f"{database}.t", ["id"], ["p"])
    assert set(root.glob("upsert-*")) == before


def test_work_folder_is_the_configured_one(spark):
    assert new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_hot_partition_is_written_by_several_tasks(spark, database):
    """Two thirds of the rows share one partition; AQE splits it while writing."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        df = spark.range(0, 300_000, numPartitions=8).select(
            "id", F.when(F.col("id") % 3 == 0, F.col("id") % 5).otherwise(7).alias("p")
        )
        ups.upsert(spark, df, f"{database}.t", ["id"], ["p"])
        ups.upsert(spark, df.where("p = 7"), f"{database}.t", ["id"], ["p"])
    finally:
        spark.conf.set(key, before)
    assert spark.table(f"{database}.t").count() == 300_000
    hot = [f for f in files(spark, f"{database}.t") if f.startswith("p=7/")]
    assert len(hot) > 2

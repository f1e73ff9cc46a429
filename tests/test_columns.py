import pytest
from pyspark.sql import functions as F

from support import explained, rows
from tierflow.operators import columns as cols
from tierflow.operators.dedupe import duplicate_counts, remove_duplicates


@pytest.fixture(scope="module")
def people(spark):
    data = [(1, " Ann-Lee ", "A B", None), (2, None, "c_d!", 4.0)]
    return spark.createDataFrame(data, "id int, name string, code string, score double")


def test_metadata_columns_in_fixed_order(spark, people):
    names = ["record_id", "layer_name", "load_date", "unknown", "load_timestamp", "load_run_id"]
    df = cols.add_metadata_columns(people, names, "BRONZE")
    assert df.columns[4:] == [
        "load_timestamp", "load_date", "load_run_id", "layer_name", "record_id"
    ]
    row = df.first()
    assert row["load_run_id"].startswith("run_20") and row["layer_name"] == "BRONZE"
    assert "layer_name" not in cols.add_metadata_columns(people, names).columns


def test_standardize_strings_only(people):
    df = cols.standardize_columns(people, True, True, True)
    assert rows(df) == rows(people.sparkSession.createDataFrame(
        [(1, "annlee", "ab", None), (2, None, "c_d", 4.0)], people.schema))
    assert rows(cols.standardize_columns(people)) == rows(people)
    assert rows(cols.standardize_columns(people, lowercase=True), "name")[0] == (" ann-lee ",)


def test_renames(spark, people):
    assert cols.rename_columns_to_uppercase(people).columns == ["ID", "NAME", "CODE", "SCORE"]
    clash = spark.createDataFrame([(1, 2)], "A int, a int")
    with pytest.raises(ValueError, match="case"):
        cols.rename_columns_to_lowercase(clash)
    # One rename may build on the one before.
    chained = cols.rename_columns_by_mapping(people, {"id": "key", "key": "k", "x": "y"})
    assert chained.columns == ["k", "name", "code", "score"]


def test_custom_columns_build_on_each_other_and_skip_failures(people):
    df = cols.add_custom_columns(
        people, {"a": "id + 1", "bad": "nothing + 1", "worse": "((", "b": "a * 2"}
    )
    assert df.columns[4:] == ["a", "b"]
    assert rows(df, "b") == [(4,), (6,)]


def test_fill_drop_select(people):
    assert rows(cols.fill_nulls(people, {"score": 0.0, "name": "?"}), "name", "score") == [
        (" Ann-Lee ", 0.0), ("?", 4.0)]
    assert cols.drop_columns(people, ["code", "none"]).columns == ["id", "name", "score"]
    assert cols.select_columns(people, ["score", "none", "id"]).columns == ["score", "id"]


def test_remove_duplicates(spark):
    df = spark.createDataFrame(
        [(1, "a", 3), (1, "b", 2), (1, "b", 2), (2, None, None), (2, None, None)],
        "k int, v string, n int",
    )
    assert remove_duplicates(df).count() == 3
    assert remove_duplicates(remove_duplicates(df)).count() == 3
    assert remove_duplicates(df, ["k"]).count() == 2
    assert rows(remove_duplicates(df, ["k"], ["n"])) == [(1, "b", 2), (2, None, None)]
    assert rows(remove_duplicates(df, ["k"], [F.col("n").desc()])) == [(1, "a", 3), (2, None, None)]
    assert rows(duplicate_counts(df)) == [(5, 3, 2)]
    assert rows(duplicate_counts(df.where("k > 9"))) == [(0, 0, 0)]


def test_copies_collapse_before_the_shuffle(spark):
    """Hundreds of thousands of copies of one key must not travel to one task."""
    df = spark.range(0, 1_000_000, numPartitions=8).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 1000).otherwise(7).alias("k"),
        (F.col("id") % 3).alias("v"),
    )
    result = remove_duplicates(df, ["k"], [F.col("v").desc()])
    assert result.count() == 101
    assert rows(result.where("k = 7")) == [(7, 2)]
    plan = explained(remove_duplicates(df, ["k"], [F.col("v").desc()]))
    assert plan.count("Exchange (") == 1
    assert plan.count("WindowGroupLimit (") == 2
    assert ", Partial" in plan

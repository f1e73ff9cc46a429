import pytest
from pyspark.sql import functions as F

from support import explained, rows
from tierflow.operators import metrics as met
from tierflow.operators import quality as qual


def test_flag_is_three_valued(spark):
    df = spark.createDataFrame(
        [(1.0, "a"), (None, "a"), (None, None), (99.0, "a"), (5.0, None)], "v double, s string"
    )
    rules = {
        "v": {"min_value": 0, "max_value": 10},
        "s": {"nulls_allowed": False},
        "absent": {"min_value": 1},
        "ignored": 3,
    }
    flagged = qual.add_data_quality_flag(df, rules)
    assert [r["quality_flag"] for r in flagged.collect()] == [True, None, False, False, False]
    assert qual.add_data_quality_flag(df, {}).where("quality_flag").count() == 5


@pytest.mark.parametrize(
    "rule",
    ["power > 0 when wind > 3", ("power > 0", "wind > 3"),
     {"check": "power > 0", "when": "wind > 3"}],
)
def test_conditional_rule(spark, rule):
    df = spark.createDataFrame(
        [(0, 5), (0, 2), (4, 5), (0, None), (None, 5)], "power int, wind int"
    )
    checked = qual.add_rule_results(df, [rule])
    assert [r["rule_1"] for r in checked.collect()] == [False, True, True, True, None]


def test_plain_rule_with_case_expression(spark):
    df = spark.createDataFrame([(1,), (3,)], "v int")
    rule = "case when v > 2 then false else true end"
    assert [r["rule_1"] for r in qual.add_rule_results(df, [rule]).collect()] == [True, False]


def test_null_percent(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (None, 1)], "a int, b int")
    assert [round(r[1], 3) for r in rows(qual.null_percent(df))] == [33.333, 33.333]
    assert rows(qual.null_percent(df.limit(0), ["a"])) == [("a", 0.0)]


def test_report_covers_every_kind_of_rule(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, "y"), (50.0, None)], "v double, s string")
    rules = {
        "v": {"max_nulls_percent": 20, "min_value": 0, "max_value": 10, "data_type": "double"},
        "s": {"nulls_allowed": False, "data_type": "int"},
        "absent": {"nulls_allowed": False},
    }
    report = {
        (r["column_name"], r["rule"]): r
        for r in qual.quality_report(df, rules, ["v < 40"]).collect()
    }
    assert report["*", "row_count"]["observed"] == 3
    assert report["*", "column_count"]["observed"] == 2
    assert report["v", "max_nulls_percent"]["observed"] == pytest.approx(100 / 3)
    assert not report["v", "max_nulls_percent"]["passed"]
    assert report["v", "min_value"]["passed"] and report["v", "min_value"]["observed"] == 1.0
    assert report["v", "max_value"]["violations"] == 1
    assert report["v", "data_type"]["passed"] and not report["s", "data_type"]["passed"]
    assert report["s", "nulls_allowed"]["violations"] == 1
    assert report["rule_1", "business_rule"]["violations"] == 1
    assert len(report) == 9


def test_report_on_empty_table_passes(spark):
    df = spark.createDataFrame([], "v double")
    rules = {"v": {"max_nulls_percent": 0, "min_value": 0, "nulls_allowed": False}}
    assert all(r["passed"] for r in qual.quality_report(df, rules).collect())


def test_report_is_one_aggregation(spark):
    df = spark.createDataFrame([(1.0, "x")], "v double, s string")
    rules = {"v": {"max_nulls_percent": 5, "min_value": 0}, "s": {"nulls_allowed": False}}
    assert explained(qual.quality_report(df, rules)).count("Exchange (") == 1


def test_validate_expectations_and_profile(spark):
    df = spark.createDataFrame([(1,), (9,)], "v int")
    checked = qual.validate_expectations(df, {"v": {"max_value": 5}}, ["v < 9 when v > 1"])
    assert rows(checked.flagged) == [(1, True), (9, False)]
    assert explained(checked.flagged).count("* Scan") == 1
    # The report is of that pass; no other one is made for it.
    report = {r["rule"]: r["violations"] for r in checked.report().collect()}
    assert report["max_value"] == 1 and report["business_rule"] == 1 and report["row_count"] == 0
    profile = qual.table_profile(df, "l").first()
    assert tuple(profile) == ("l", 2, 1, "struct<v:int>")


@pytest.mark.parametrize(
    "grain, start",
    [("daily", "2024-01-07 00"), ("hourly", "2024-01-07 10"), ("weekly", "2024-01-01 00"),
     ("monthly", "2024-01-01 00")],
)
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_grains(spark, grain, start, kind):
    df = spark.sql(f"select {kind}'2024-01-07 10:20:30' as t")
    result = met.add_grain(df, grain, "t")
    assert dict(result.dtypes)["agg_date"] == kind
    assert str(result.first()["agg_date"])[:13] == start


@pytest.mark.parametrize(
    ("text", "parts"),
    [
        ("v > 1", ("v > 1", None)),
        ("v > 1 when w = 2", ("v > 1", "w = 2")),
        ("v > 1  WHEN\nw = 2", ("v > 1", "w = 2")),
        ("case when a then b end", ("case when a then b end", None)),
        ("case when a then b end > 1 when c", ("case when a then b end > 1", "c")),
        ("v > 1 when case when a then b else c end", ("v > 1", "case when a then b else c end")),
        ("s = 'only when wet'", ("s = 'only when wet'", None)),
        ("s = 'it''s when' when `a when b` = 1", ("s = 'it''s when'", "`a when b` = 1")),
        ('s = "a when b" when t', ('s = "a when b"', "t")),
        ("when > 3", ("when > 3", None)),
        ("whenever > 3", ("whenever > 3", None)),
        ("a when b when c", ("a", "b when c")),
    ],
)
def test_rules_are_split_outside_quotes_and_cases(text, parts):
    assert qual.split_rule(text) == parts


def test_unknown_grain_or_column_adds_nothing(spark):
    df = spark.sql("select timestamp'2024-01-07 10:20:30' as t, 1 as v")
    assert met.add_grain(df, "yearly", "t").columns == ["t", "v"]
    assert met.add_grain(df, "daily").columns == ["t", "v"]
    with pytest.raises(ValueError, match="agg_date"):
        met.calculate_metrics(met.add_grain(df, "yearly", "t"), {"n": "count(*)"}, ["agg_date"])


def test_metrics(spark):
    df = spark.createDataFrame([(1, 2, None), (1, 2, 4), (2, 3, 5)], "k int, a int, b int")
    metrics = {"u": "count(distinct a)", "s": "sum(coalesce(b, 0))", "n": "count(*)"}
    assert rows(met.calculate_metrics(df, metrics, ["k"])) == [(1, 1, 4, 2), (2, 1, 5, 1)]
    assert met.calculate_metrics(df, metrics, []).columns == df.columns
    assert met.calculate_metrics(df, {}, ["k"]).columns == df.columns


def test_report_metadata(spark):
    row = met.add_report_metadata(spark.range(1)).select(
        (F.col("report_generated_at").cast("string") == F.col("report_version")).alias("same")
    ).first()
    assert row["same"]

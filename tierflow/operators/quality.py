"""Quality flags, expectation rules, business rules and reports.

Rules are given per column as a dict with any of ``nulls_allowed``,
``max_nulls_percent``, ``min_value``, ``max_value`` and ``data_type``. All
figures for all rules come from one aggregation whose partial results are one
row per task.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tierflow.operators.observe import Watch

Rules = Mapping[str, Mapping[str, Any]]
BusinessRule = str | tuple[str, str] | Mapping[str, str]


def _applicable(df: DataFrame, rules: Rules) -> dict[str, Mapping[str, Any]]:
    """The rules whose column exists and that are given as a dict."""
    return {
        c: r for c, r in rules.items() if c in df.columns and isinstance(r, Mapping)
    }


def declared_type(text: str) -> DataType:
    """The type a DDL name such as ``double`` stands for."""
    return StructType.fromDDL(f"v {text}")["v"].dataType


def _forbids_nulls(rule: Mapping[str, Any]) -> bool:
    return not rule.get("nulls_allowed", True)


# --- row flag --------------------------------------------------------------


def quality_condition(df: DataFrame, rules: Rules) -> Column:
    """All row-level rules joined by AND.

    Three-valued: a null compared with a bound is null, so the result is null
    unless another rule is false.
    """
    terms = [F.lit(True)]
    for name, rule in _applicable(df, rules).items():
        value = F.col(f"`{name}`")
        if _forbids_nulls(rule):
            terms.append(value.isNotNull())
        if "min_value" in rule:
            terms.append(value >= rule["min_value"])
        if "max_value" in rule:
            terms.append(value <= rule["max_value"])
    return reduce(and_, terms)


def add_data_quality_flag(df: DataFrame, rules: Rules) -> DataFrame:
    """Add ``quality_flag``."""
    return df.withColumn("quality_flag", quality_condition(df, rules))


# --- business rules --------------------------------------------------------


# Quoted texts and names are skipped; of the words only these count.
_TOKENS = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|\b(?:case|when|end)\b", re.IGNORECASE | re.DOTALL)


def split_rule(text: str) -> tuple[str, str | None]:
    """Check and condition of a rule given as text.

    It is cut at the first ``when``, in either case, that stands outside quotes and
    outside ``case … end`` with something on both sides. Without one the whole text
    is a plain rule.
    """
    depth = 0
    for found in _TOKENS.finditer(text):
        word = found[0].lower()
        if word == "case":
            depth += 1
        elif word == "end":
            depth -= depth > 0
        elif word == "when" and depth == 0:
            check, when = text[: found.start()], text[found.end() :]
            if check.strip() and when.strip() and check[-1].isspace() and when[0].isspace():
                return check.strip(), when.strip()
    return text, None


def business_condition(rule: BusinessRule) -> Column:
    """One business rule as a condition.

    A plain rule is a SQL condition. A conditional rule is a pair (check,
    when), a dict with those two keys, or the text ``"check when condition"``:
    the check must hold wherever the condition does.
    """
    if isinstance(rule, Mapping):
        check, when = rule["check"], rule.get("when")
    elif isinstance(rule, str):
        check, when = split_rule(rule)
    else:
        check, when = rule
    if not when:
        return F.expr(check)
    return ~F.coalesce(F.expr(when), F.lit(False)) | F.expr(check)


def add_rule_results(df: DataFrame, rules: Sequence[BusinessRule]) -> DataFrame:
    """Add ``rule_1``, ``rule_2``, … with the outcome of each rule per row."""
    return df.withColumns(
        {f"rule_{i}": business_condition(r) for i, r in enumerate(rules, start=1)}
    )


def rule_text(rule: BusinessRule) -> str:
    if isinstance(rule, str):
        return rule
    check, when = (
        (rule["check"], rule.get("when")) if isinstance(rule, Mapping) else rule
    )
    return f"{check} when {when}" if when else check


# --- reports ---------------------------------------------------------------


class Expectations:
    """Rules bound to a table: what to aggregate, and how to report it.

    ``metrics`` can be evaluated by an aggregation of its own or observed
    while the table is being written; ``report`` turns the resulting single row
    into one row per (column, rule).
    """

    def __init__(
        self,
        df: DataFrame,
        rules: Rules | None = None,
        business_rules: Sequence[BusinessRule] = (),
        table_lines: bool = True,
    ):
        self._metrics: dict[str, Column] = {"row_count": F.count(F.lit(1))}
        rows = F.col("row_count")
        none = F.lit(None).cast("double")
        zero = F.lit(0).cast("long")
        self._lines: list[Column] = []
        if table_lines:
            self._add("*", "row_count", None, rows, zero, F.lit(True))
            self._add("*", "column_count", None, F.lit(len(df.columns)), zero, F.lit(True))
        types = {f.name: f.dataType for f in df.schema.fields}
        for name, rule in _applicable(df, rules or {}).items():
            value = F.col(f"`{name}`")

            if _forbids_nulls(rule):
                n = self._count(value.isNull())
                self._add(name, "nulls_allowed", "false", n, n, n == 0)

            if "max_nulls_percent" in rule:
                limit = float(rule["max_nulls_percent"])
                n = self._count(value.isNull())
                percent = F.coalesce(F.try_divide(n * 100.0, rows), F.lit(0.0))
                over = F.when(percent > limit, n).otherwise(zero)
                self._add(name, "max_nulls_percent", limit, percent, over, percent <= limit)

            for key, extreme, outside in (
                ("min_value", F.min, lambda v, limit: v < limit),
                ("max_value", F.max, lambda v, limit: v > limit),
            ):
                if key in rule:
                    n = self._count(outside(value, rule[key]))
                    seen = self._metric(extreme(value))
                    self._add(name, key, float(rule[key]), seen, n, n == 0)

            if "data_type" in rule:
                right = types[name] == declared_type(rule["data_type"])
                broken = zero if right else rows
                self._add(name, "data_type", rule["data_type"], none, broken, F.lit(right))
        for i, rule in enumerate(business_rules, start=1):
            n = self._count(~business_condition(rule))
            self._add(f"rule_{i}", "business_rule", rule_text(rule), none, n, n == 0)

    def _metric(self, aggregate: Column) -> Column:
        name = f"m{len(self._metrics)}"
        self._metrics[name] = aggregate
        return F.col(name)

    def _count(self, condition: Column) -> Column:
        return self._metric(F.count_if(condition))

    def _add(self, name, rule, limit, observed, violations, passed) -> None:
        text = None if limit is None else str(limit)
        self._lines.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(rule).alias("rule"),
                F.lit(text).cast("string").alias("rule_limit"),
                observed.cast("double").alias("observed"),
                violations.cast("long").alias("violations"),
                passed.alias("passed"),
            )
        )

    @property
    def metrics(self) -> list[Column]:
        return [c.alias(n) for n, c in self._metrics.items()]

    def report(self, metric_row: DataFrame) -> DataFrame:
        return metric_row.select(F.explode(F.array(*self._lines)).alias("line")).select("line.*")

    def report_observed(self, spark: SparkSession, values: Mapping[str, Any]) -> DataFrame:
        """The report on figures that were observed during a write."""
        row = spark.range(1).select(
            *[F.lit(values.get(n, 0 if n == "row_count" else None)).alias(n) for n in self._metrics]
        )
        return self.report(row)


def quality_report(
    df: DataFrame,
    rules: Rules | None = None,
    business_rules: Sequence[BusinessRule] = (),
) -> DataFrame:
    """Row and column count, then one row per (column, rule).

    A percentage or extreme is in ``observed``; ``violations`` counts the rows
    that break the rule.
    """
    expectations = Expectations(df, rules, business_rules)
    return expectations.report(df.agg(*expectations.metrics))


class Validation:
    """A table with its ``quality_flag``, whose rules are observed while it is read.

    Write ``flagged``, or run any other action that reads all of it behind narrow
    operators; the report is of that one pass.
    """

    def __init__(self, df: DataFrame, rules: Rules, business_rules: Sequence[BusinessRule] = ()):
        self._expectations = Expectations(df, rules, business_rules)
        self._source = df
        self._watch = Watch(add_data_quality_flag(df, rules), self._expectations.metrics)
        self.flagged = self._watch.df

    def report(self) -> DataFrame:
        """One row per (column, rule), as ``quality_report`` gives it; waits for the action."""
        return self._expectations.report_observed(self._source.sparkSession, self._watch.values)


def validate_expectations(
    df: DataFrame, rules: Rules, business_rules: Sequence[BusinessRule] = ()
) -> Validation:
    """Flag the rows of a table and report on the rules, in one pass."""
    return Validation(df, rules, business_rules)


def null_percent(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Percentage of nulls per column; 0 for an empty table."""
    names = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(names)],
    )
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.coalesce(
                F.try_divide(F.col(f"m{i}") * 100.0, F.col("n")), F.lit(0.0)
            ).alias("null_percent"),
        )
        for i, c in enumerate(names)
    ]
    return counts.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def table_profile(df: DataFrame, label: str = "") -> DataFrame:
    """One row with the label, row count, column count and schema."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(label).alias("label"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(df.schema.simpleString()).alias("schema"),
    )

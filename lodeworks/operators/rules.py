"""Expectation rules compiled to column expressions: one pass per table, whatever the rule count."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.constants import BETWEEN, GRADES_CHECKPOINT, LENGTH, NOT_NULL, QUALITY_RULES, UNIQUE
from lodeworks.functions import half_up
from lodeworks.operators.dedup import digest, hashable, surplus
from lodeworks.sources.literal import literal_table

RESULT_COLUMNS = ["rule_no", "expectation", "column_name", "success", "unexpected_count", "unexpected_pct", "error"]


@dataclass(frozen=True)
class Rule:
    kind: str
    columns: tuple[str, ...]
    min_value: float | None = None
    max_value: float | None = None

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def rules_for(system: str, table: str) -> list[Rule]:
    return [Rule(*spec) for spec in QUALITY_RULES.get((system, table), [])]


def _within(value: str, rule: Rule) -> str:
    bounds = [f"{value} >= {rule.min_value}"] if rule.min_value is not None else []
    bounds += [f"{value} <= {rule.max_value}"] if rule.max_value is not None else []
    return " AND ".join(bounds) or "TRUE"


def unexpected(rule: Rule, ignore_nulls: bool = False) -> str:
    """Row condition, as a SQL expression, under which a row breaks the rule. NULL breaks a range
    unless told otherwise."""
    value = f"`{rule.columns[0]}`"
    if rule.kind == NOT_NULL:
        return f"{value} IS NULL"
    if rule.kind == LENGTH:
        value = f"length(CAST({value} AS STRING))"
    return f"NOT coalesce({_within(value, rule)}, {str(ignore_nulls).upper()})"


def _problem(rule: Rule, columns: list[str]) -> str | None:
    if rule.kind not in (NOT_NULL, BETWEEN, LENGTH, UNIQUE):
        return f"unknown expectation: {rule.kind}"
    missing = [c for c in rule.columns if c not in columns]
    return f"no such column: {','.join(missing)}" if missing else None


def _surplus_of_all(df: DataFrame, rules: list[tuple[int, Rule]]) -> DataFrame:
    """Rows after the first of each key, for several key sets in one pass: each row is laid out once per
    rule as a digest of its key. One row: ``_rows``, and ``_dup_<no>`` for each rule."""
    sets = [F.struct(F.lit(no).alias("no"), *[h.alias(f"h{i}") for i, h in enumerate(digest(list(rule.columns)))]) for no, rule in rules]
    counted = df.select(F.inline(F.array(*sets))).groupBy("no", "h0", "h1").agg(F.count(F.lit(1)).alias("n"))

    def of(no: int, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("no") == no, value)), F.lit(0)).cast("bigint")

    return counted.agg(of(rules[0][0], F.col("n")).alias("_rows"), *[of(no, F.col("n") - 1).alias(f"_dup_{no}") for no, _ in rules])


def evaluate(df: DataFrame, rules: list[Rule], ignore_nulls: bool = False) -> DataFrame:
    """One row per rule. A rule that cannot run is reported as failed and stops nothing."""
    row_rules, unique_rules, broken = [], [], []
    for no, rule in enumerate(rules, 1):
        problem = _problem(rule, df.columns)
        if problem:
            broken.append((no, rule.kind, rule.label, False, -1, -1.0, problem))
        else:
            (unique_rules if rule.kind == UNIQUE else row_rules).append((no, rule))

    def outcome(no: int, rule: Rule, bad: str, total: str) -> str:
        share = f"coalesce(try_divide({bad} * 100D, {total}), 0D)"
        return (
            f"named_struct('rule_no', {no}, 'expectation', '{rule.kind}', 'column_name', '{rule.label}', 'success', {bad} = 0, "
            f"'unexpected_count', {bad}, 'unexpected_pct', CAST(floor({share} * 1000D + 0.5D) AS DOUBLE) / 1000D, 'error', CAST(NULL AS STRING))"
        )

    parts = []
    if row_rules:
        counts = df.selectExpr(
            "count(1) AS _total", *[f"count_if({unexpected(rule, ignore_nulls)}) AS _bad_{no}" for no, rule in row_rules]
        )
        outcomes = ", ".join(outcome(no, rule, f"_bad_{no}", "_total") for no, rule in row_rules)
        parts.append(counts.selectExpr(f"inline(array({outcomes}))"))
    if len(unique_rules) > 1 and all(hashable(df, rule.columns) for _, rule in unique_rules):
        counted = _surplus_of_all(df, unique_rules)
        parts.append(counted.selectExpr("inline(array(" + ", ".join(outcome(no, rule, f"_dup_{no}", "_rows") for no, rule in unique_rules) + "))"))
    else:
        for no, rule in unique_rules:
            counted = surplus(df.select(*rule.columns), list(rule.columns))
            parts.append(counted.selectExpr(f"inline(array({outcome(no, rule, 'dup', 'total')}))"))
    if broken:
        parts.append(
            literal_table(
                df.sparkSession,
                broken,
                "rule_no int, expectation string, column_name string, success boolean, "
                "unexpected_count bigint, unexpected_pct double, error string",
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def grade(score: Column, scale: list[tuple[float, str]], lowest: str = "D") -> Column:
    (cut, label), *rest = scale
    chain = F.when(score >= F.lit(cut), F.lit(label))
    for cut, label in rest:
        chain = chain.when(score >= F.lit(cut), F.lit(label))
    return chain.otherwise(F.lit(lowest))


def scored(results: DataFrame, by: list[str], scale: list[tuple[float, str]] = GRADES_CHECKPOINT, digits: int = 2) -> DataFrame:
    """passed / failed / score / grade per group of rule results."""
    exact = F.try_divide(F.col("passed") * F.lit(100.0), F.col("passed") + F.col("failed"))
    return (
        results.groupBy(*by)
        .agg(F.count_if(F.col("success")).alias("passed"), F.count_if(~F.col("success")).alias("failed"))
        .withColumn("grade", grade(F.coalesce(exact, F.lit(0.0)), scale))
        .withColumn("score", half_up(F.coalesce(exact, F.lit(0.0)), digits))
    )


def checkpoint(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Rule results of many tables, labelled by system and table."""
    result = None
    for (system, table), df in tables.items():
        part = evaluate(df, rules_for(system, table)).select(
            F.lit(system).alias("system"), F.lit(table).alias("table_name"), *RESULT_COLUMNS
        )
        result = part if result is None else result.unionByName(part)
    return result

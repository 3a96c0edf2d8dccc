"""Row-level quality rules: warn (count), drop, quarantine.

A rule is a name plus a SQL predicate. A row passes a rule only when the
predicate is TRUE; FALSE and NULL both fail (``coalesce(p, false)``). All
rule flags are computed in one projection; metrics come from a single
global aggregate (partial per task), so no step groups rows by rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

FAILED_RULES = "_failed_rules"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str  # SQL boolean expression

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def rules_from(mapping: dict[str, str]) -> list[Rule]:
    return [Rule(k, v) for k, v in mapping.items()]


def all_pass(rules: list[Rule]) -> Column:
    cond = F.lit(True)
    for r in rules:
        cond = cond & r.passes()
    return cond


def failed_rules(rules: list[Rule]) -> Column:
    """ARRAY<STRING> of the names of the rules a row fails (empty when clean)."""
    return F.array_compact(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules]))


def expect(df: DataFrame, rules: list[Rule], name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Warn: keep every row; the Observation reports total rows and failures per rule.

    The metrics are filled when the returned DataFrame is executed (once).
    """
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")] + [F.count_if(~r.passes()).alias(r.name) for r in rules]
    return df.observe(obs, *metrics), obs


def expect_or_drop(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Drop: rows failing any rule are removed."""
    return df.filter(all_pass(rules))


def quarantine(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows with ``_failed_rules``) — nothing is lost."""
    flagged = df.withColumn(FAILED_RULES, failed_rules(rules))
    clean = flagged.filter(F.size(FAILED_RULES) == 0).drop(FAILED_RULES)
    rejected = flagged.filter(F.size(FAILED_RULES) > 0)
    return clean, rejected


def rule_metrics(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row: ``rows`` and one failure count per rule (a single global aggregate)."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(~r.passes()).alias(r.name) for r in rules])


def violations_by_rule(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, n) for every rule with at least one failing row."""
    wide = rule_metrics(df, rules).drop("rows")
    stacked = wide.unpivot([], [r.name for r in rules], "rule", "n")
    return stacked.filter(F.col("n") > 0)

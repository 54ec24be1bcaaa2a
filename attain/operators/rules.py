"""Declarative data-quality rules: a rule is a boolean Column with an id, a severity and an action."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attain.policy import Policy

DROP, QUARANTINE, FIX, FLAG = "DROP", "QUARANTINE", "FIX", "FLAG"


@dataclass(frozen=True)
class Rule:
    rule_id: str
    table: str
    description: str
    severity: str
    action: str
    check: Callable[[Policy], Column] | None = None

    def flag(self, policy: Policy) -> Column:
        """True where the rule is broken; an unknown result passes."""
        return F.coalesce(self.check(policy), F.lit(False))


def failed_ids(rules: list[Rule], policy: Policy, action: str) -> Column:
    """Ids of the broken rules of one action in rule order, joined by semicolons; empty when none is."""
    hits = [F.when(r.flag(policy), F.lit(r.rule_id)) for r in rules if r.action == action and r.check]
    return F.concat_ws(";", *hits)


def first_failed(rules: list[Rule], policy: Policy) -> Column:
    """Id of the first broken rule, empty when none is."""
    return F.coalesce(*[F.when(r.flag(policy), F.lit(r.rule_id)) for r in rules], F.lit(""))


def log_entry(rule: Rule, rows: Column, of: Column | None) -> Column:
    share = F.lit(None).cast("double") if of is None else F.coalesce(
        F.round(F.try_divide(F.lit(100.0) * rows, of.cast("double")), 3), F.lit(0.0))
    return F.struct(F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.table).alias("table"),
                    F.lit(rule.description).alias("description"), F.lit(rule.severity).alias("severity"),
                    F.lit(rule.action).alias("action"), rows.cast("long").alias("rows_affected"),
                    share.alias("pct_of_rows"))


def rule_counts(df: DataFrame, flags: dict[str, Column], total: str = "_total") -> DataFrame:
    """All rule counts in one aggregate: one row, one column per rule."""
    return df.agg(F.count(F.lit(1)).alias(total),
                  *[F.count(F.when(flag, 1)).alias(name) for name, flag in flags.items()])


def rule_log(counts: DataFrame, rules: list[Rule], corrections: list[Rule] = (), total: str = "_total") -> DataFrame:
    """Turn the one-row counts into one log row per rule; corrections are logged without a share."""
    entries = F.array(*[log_entry(r, F.col(f"`{r.rule_id}`"), None) for r in corrections],
                      *[log_entry(r, F.col(f"`{r.rule_id}`"), F.col(total)) for r in rules])
    return counts.select(F.explode(entries).alias("_e")).select("_e.*")


def evaluate(df: DataFrame, rules: list[Rule], policy: Policy) -> tuple[DataFrame, DataFrame]:
    """Flag every row with every rule and count the hits; rules are independent of each other."""
    checked = [r for r in rules if r.check]
    flagged = df.select("*", *[r.flag(policy).alias(r.rule_id) for r in checked])
    counts = rule_counts(df, {r.rule_id: r.flag(policy) for r in checked})
    return flagged, rule_log(counts, checked)

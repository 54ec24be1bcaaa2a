"""Business policy: effective-dated commission plans, thresholds and reference rows.

A policy is plain typed data. Everything that has to meet fact rows is turned into a small
DataFrame whose size is fixed by the policy itself (tiers, months), never by the data.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NO_TARGET, NO_PLAN = "No Target", "No Plan"


@dataclass(frozen=True)
class Tier:
    name: str
    floor: float
    ceiling: float
    rate: Decimal


@dataclass(frozen=True)
class Plan:
    plan_id: str
    name: str
    effective_from: dt.date
    effective_to: dt.date
    tiers: tuple[Tier, ...]
    strategic_weight: Decimal = Decimal("1.25")
    cap_multiple: Decimal = Decimal("1.50")
    clawback_days: int = 90


# Tier names, edges and rates of the incentive plans.
def standard_tiers(gate: float) -> tuple[Tier, ...]:
    return (
        Tier("T0 Below Gate", -99.0, gate, Decimal("0.0000")),
        Tier("T1 Approaching", gate, 1.0, Decimal("0.0050")),
        Tier("T2 On Target", 1.0, 1.2, Decimal("0.0100")),
        Tier("T3 Accelerator", 1.2, 99.0, Decimal("0.0150")),
    )


# Country spellings accepted for each market code.
MARKET_ALIASES = {
    "egypt": "EG", "egy": "EG", "eg": "EG", "arab republic of egypt": "EG",
    "saudi arabia": "SA", "ksa": "SA", "saudi": "SA", "sa": "SA", "kingdom of saudi arabia": "SA",
    "uae": "AE", "u.a.e": "AE", "u.a.e.": "AE", "united arab emirates": "AE", "ae": "AE",
    "oman": "OM", "sultanate of oman": "OM", "om": "OM",
}
MARKET_NAMES = ("Egypt", "Saudi Arabia", "UAE", "Oman")

# Market and department reference rows.
MARKETS = (
    ("EG", "Egypt", "EGP", "North Africa"),
    ("SA", "Saudi Arabia", "SAR", "GCC"),
    ("AE", "UAE", "AED", "GCC"),
    ("OM", "Oman", "OMR", "GCC"),
)
DEPARTMENTS = (("ENT", "Enterprise Sales"), ("SME", "SME Sales"), ("CHN", "Channel & Partner Sales"))

# Share of the monthly base quota planned for January..December.
PLAN_PHASING = ("0.88", "0.95", "1.00", "1.00", "1.00", "1.04", "0.95", "0.92", "1.00", "1.04", "1.08", "1.14")
RAMP_FACTORS = ("0.40", "0.65", "0.85")


@dataclass(frozen=True)
class Policy:
    start: dt.date = dt.date(2024, 1, 1)
    end: dt.date = dt.date(2025, 12, 31)
    plans: tuple[Plan, ...] = (
        Plan("CP2024", "2024 Sales Incentive Plan", dt.date(2024, 1, 1), dt.date(2024, 12, 31), standard_tiers(0.80)),
        Plan("CP2025", "2025 Sales Incentive Plan", dt.date(2025, 1, 1), dt.date(2025, 12, 31), standard_tiers(0.85)),
    )
    strategic_lines: tuple[str, ...] = ("Cybersecurity", "Managed Services")
    markets: tuple[tuple[str, str, str, str], ...] = MARKETS
    departments: tuple[tuple[str, str], ...] = DEPARTMENTS
    aliases: dict[str, str] = field(default_factory=lambda: dict(MARKET_ALIASES))
    canonical_names: tuple[str, ...] = MARKET_NAMES
    ramp_months: int = len(RAMP_FACTORS)
    month_end_days: int = 3
    month_end_share: float = 0.50
    reversal_days: int = 60
    reversal_share: float = 0.25
    anomaly_mad: float = 3.5
    window_months: int = 12
    min_months_on_target: int = 9
    min_months: int = 6
    decline_months: int = 6
    decline_slope: float = -5.0
    decline_latest: float = 0.90
    under_threshold: float = 0.80
    compare_years: tuple[int, int] = (2024, 2025)
    home_region: str = "GCC"
    home_label: str = "gcc"
    other_label: str = "egypt"
    statement_month: int = 202512

    def with_(self, **changes) -> "Policy":
        return replace(self, **changes)

    @property
    def strategic_weight(self) -> Decimal:
        return self.plans[0].strategic_weight


def values(spark: SparkSession, rows: list[tuple], columns: dict[str, str]) -> DataFrame:
    """Policy rows as a local relation: the planner knows its exact (small) size."""
    def literal(value) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, dt.date):
            return f"DATE '{value.isoformat()}'"
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return str(value)

    tuples = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    typed = ", ".join(f"CAST(c{i} AS {kind}) AS {name}" for i, (name, kind) in enumerate(columns.items()))
    names = ", ".join(f"c{i}" for i in range(len(columns)))
    return spark.sql(f"SELECT {typed} FROM VALUES {tuples} AS v({names})")


def plan_tiers(spark: SparkSession, policy: Policy) -> DataFrame:
    """One row per plan and tier (the commission plan dimension)."""
    rows, key = [], 0
    for plan in policy.plans:
        for order, tier in enumerate(plan.tiers, start=1):
            key += 1
            rows.append((key, plan.plan_id, plan.name, plan.effective_from, plan.effective_to, order, tier.name,
                         tier.floor, tier.ceiling, tier.rate, plan.strategic_weight, plan.cap_multiple,
                         plan.clawback_days))
    return values(spark, rows, {
        "plan_tier_key": "int", "plan_id": "string", "plan_name": "string", "effective_from": "date",
        "effective_to": "date", "tier_order": "int", "tier_name": "string", "min_achievement": "double",
        "max_achievement": "double", "commission_rate": "decimal(5,4)", "strategic_weight": "decimal(4,2)",
        "cap_multiple_of_target": "decimal(4,2)", "clawback_window_days": "int"})


def plan_months(tiers: DataFrame) -> DataFrame:
    """Plan parameters per month that begins inside the plan's dates: the range becomes an equi-join key."""
    first = F.when(F.dayofmonth("effective_from") > 1, F.add_months(F.trunc("effective_from", "MM"), 1)).otherwise(F.col("effective_from"))
    months = F.when(first <= F.col("effective_to"), F.sequence(first, F.col("effective_to"), F.expr("interval 1 month")))
    plans = tiers.select("plan_id", "plan_name", "effective_from", "effective_to", "cap_multiple_of_target", "clawback_window_days").distinct()
    return (plans.withColumn("_m", F.explode(months))
            .select((F.year("_m") * 100 + F.month("_m")).cast("int").alias("month_key"), "plan_id", "plan_name",
                    "cap_multiple_of_target", "clawback_window_days"))


def tier_bands(tiers: DataFrame) -> DataFrame:
    """Half-open achievement bands per plan, the outermost ones open-ended (null edge)."""
    ends = tiers.groupBy("plan_id").agg(F.min("tier_order").alias("_lowest"), F.max("tier_order").alias("_highest"))
    return tiers.join(ends, "plan_id").select(
        "plan_id", "tier_name", "commission_rate",
        F.when(F.col("tier_order") > F.col("_lowest"), F.col("min_achievement")).alias("band_floor"),
        F.when(F.col("tier_order") < F.col("_highest"), F.col("max_achievement")).alias("band_ceiling"))

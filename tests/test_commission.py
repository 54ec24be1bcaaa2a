"""Tier edges, weights, cap, clawback window and plan versions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from attain.plans.commission import commission_rep_month, plan_by_month, uncovered_months
from attain.policy import Policy, plan_months, plan_tiers
from frames import line, tiny_model

GATE_2024 = {0.7999: 0, 0.80: 0.005, 0.9999: 0.005, 1.0: 0.010, 1.1999: 0.010, 1.20: 0.015, 3.5: 0.015, -0.3: 0,
             150.0: 0.015, -120.0: 0}
GATE_2025 = {0.84: 0, 0.85: 0.005}


def price(spark, lines, targets, policy=None):
    rows = commission_rep_month(tiny_model(spark, lines, targets, policy)).collect()
    return {(r["rep_key"], r["month_key"]): r for r in rows}


def test_plan_in_force_by_month(spark):
    by_month = {r["month_key"]: r["plan_id"] for r in plan_months(plan_tiers(spark, Policy())).collect()}
    assert by_month[202406] == "CP2024" and by_month[202506] == "CP2025" and len(by_month) == 24


def test_plan_starting_mid_month_begins_with_the_next(spark):
    policy = Policy()
    late = policy.with_(plans=(policy.plans[0].__class__("X", "X", dt.date(2024, 1, 15), dt.date(2024, 3, 31),
                                                         policy.plans[0].tiers),))
    assert [r["month_key"] for r in plan_months(plan_tiers(spark, late)).orderBy("month_key").collect()] == [202402, 202403]


def test_pay_follows_the_plan_table(spark):
    m = tiny_model(spark, [line(1, "INV", 130_000)], {(1, 202406): 100_000})
    raised = F.when(F.col("tier_name") == "T3 Accelerator", F.lit(Decimal("0.9000"))).otherwise(F.col("commission_rate"))
    other = m.with_(tiers=m.tiers.withColumn("commission_rate", raised.cast("decimal(5,4)")))
    assert commission_rep_month(m).first()["commission"] == Decimal("1950")
    assert commission_rep_month(other).first()["commission"] == Decimal("117000")


@pytest.mark.parametrize("month, cases", [(202406, GATE_2024), (202506, GATE_2025)])
def test_half_open_tier_edges(spark, month, cases):
    lines, targets = [], {}
    for i, achievement in enumerate(cases, start=1):
        net = round(achievement * 100_000, 2)
        lines.append(line(i, "INV" if net > 0 else "CN", net, month, rep=i, days=10))
        targets[(i, month)] = 100_000
    got = price(spark, lines, targets)
    for i, (achievement, rate) in enumerate(cases.items(), start=1):
        assert float(got[(i, month)]["commission_rate"]) == rate, achievement


def test_missing_target_earns_nothing(spark):
    r = price(spark, [line(1, "INV", 500)], {(1, 202406): None})[(1, 202406)]
    assert (r["tier_name"], float(r["commission"]), r["is_capped"], r["achievement_band"]) == (
        "No Target", 0, 0, "No Target")
    assert r["cap_amount"] is None and r["achievement"] is None


@pytest.mark.parametrize("name, lines, tier, commission", [
    ("on target", [line(1, "INV", 105_000)], "T2 On Target", "1050"),
    ("weight pays but does not lift the tier", [line(1, "INV", 90_000, weight="1.25")], "T1 Approaching", "562.5"),
    ("cap", [line(1, "INV", 400_000)], "T3 Accelerator", "2250"),
    ("clawback only inside the window",
     [line(1, "INV", 120_000), line(2, "CN", -10_000, days=30), line(3, "CN", -5_000, days=120)], "T2 On Target", "1100"),
    ("window is inclusive", [line(1, "INV", 120_000), line(2, "CN", -10_000, days=90)], "T2 On Target", "1100"),
    ("worked example", [line(1, "INV", 70_000), line(2, "INV", 40_000, weight="1.25"),
                        line(3, "CN", -8_000, weight="1.25", days=25), line(4, "CN", -2_000, days=120)],
     "T2 On Target", "1100"),
])
def test_hand_built_cases(spark, name, lines, tier, commission):
    r = price(spark, lines, {(1, 202406): 100_000})[(1, 202406)]
    assert (r["tier_name"], r["commission"]) == (tier, Decimal(commission)), name
    assert r["is_capped"] == (1 if name == "cap" else 0)


def test_late_credit_notes_are_reported(spark):
    lines = [line(1, "INV", 120_000), line(2, "CN", -10_000, days=30), line(3, "CN", -5_000, days=120)]
    r = price(spark, lines, {(1, 202406): 100_000})[(1, 202406)]
    assert (r["credit_notes_outside_window"], r["commissionable_base"]) == (-5_000, 110_000)


def test_uncovered_months_are_reported_and_not_priced(spark):
    m = tiny_model(spark, [line(1, "INV", 100, 202306)], {(1, 202306): 100, (1, 202406): 100})
    assert [r["month_key"] for r in uncovered_months(m).collect()] == [202306]
    rows = {r["month_key"]: r for r in commission_rep_month(m).collect()}
    assert (rows[202306]["actual"], rows[202306]["commission"], rows[202306]["tier_name"]) == (100, 0, "No Plan")
    assert rows[202406]["tier_name"] != "No Plan" and len(rows) == 2
    assert {r["month_key"]: r["plan_id"] for r in plan_by_month(m).collect()} == {202306: None, 202406: "CP2024"}

"""Tiny models built row by row."""

from __future__ import annotations

from decimal import Decimal

from attain.plans.model import Model
from attain.policy import Policy, plan_tiers

FACT = """line_id long, document_no string, doc_type string, original_document_no string, month_key int, rep_key long,
    team_key int, product_key long, customer_key long, gross_amount_usd decimal(18,2), discount_amount_usd decimal(18,2),
    net_amount_usd decimal(18,2), gross_margin_usd decimal(18,2), commission_weight decimal(4,2),
    days_since_original int, is_month_end_window int"""


def line(i, kind, net, month=202406, rep=1, weight="1.00", days=None, document=None, original=None, gross=None, end=0,
         team=1):
    gross = net if gross is None else gross
    money = lambda v: Decimal(str(v)).quantize(Decimal("0.01"))
    return (i, document or f"{kind}-{i}", kind, original, month, rep, team, 1, 1, money(gross), money(gross - net),
            money(net), money(net), Decimal(weight), days, end)


def tiny_model(spark, lines, targets, policy=None, months=None):
    """Reps are the keys of targets: {(rep, month): amount or None}."""
    policy = policy or Policy()
    bridge = [(rep, month, 1, 12, 0) for rep, month in targets]
    reps = sorted({rep for rep, _ in targets})
    frame = spark.createDataFrame
    return Model(
        policy, tiers=plan_tiers(spark, policy), fact_sales=frame(lines, FACT),
        fact_targets=frame([(r, 1, mk, Decimal(str(t)), 0) for (r, mk), t in targets.items() if t is not None],
                           "rep_key long, team_key int, month_key int, target_amount_usd decimal(18,2), is_ramp_month int"),
        fact_team_plan=frame([(1, mk, 2, Decimal("200000")) for mk in sorted({mk for _, mk in targets})],
                             "team_key int, month_key int, planned_headcount int, plan_amount_usd decimal(18,2)"),
        bridge=frame(bridge, "rep_key long, month_key int, team_key int, tenure_months int, is_ramp_month int"),
        dim_team=frame([(1, "T01", "Team", "ENT", "EG", "Egypt")],
                       "team_key int, team_id string, team_name string, department_code string, country_code string, "
                       "country_name string"),
        dim_country=frame([("EG", "Egypt", "EGP", "North Africa")],
                          "country_code string, country_name string, currency string, region string"),
        dim_employee=frame([(r, f"REP-{r}", f"Rep {r}", "Sales Representative", "ENT") for r in reps],
                           "employee_key long, employee_code string, full_name string, role string, "
                           "department_code string"),
        dim_product=frame([(1, "P")], "product_key long, product_name string"),
        dim_customer=frame([(1, "C")], "customer_key long, customer_name string"))

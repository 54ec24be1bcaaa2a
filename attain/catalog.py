"""Registry: every query by name, each a function of (spark, data folder)."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attain.operators import checks
from attain.operators.dedupe import keep_first
from attain.operators.joins import many
from attain.operators.rules import evaluate
from attain.plans import analysis, commission, etl, kpi, metrics, questions, reports, sqlviews
from attain.sources import io
from attain.sources.ledger import LedgerModel, line_accounting
from attain.sources.stage import fingerprint, remove

Query = Callable[[SparkSession, str], DataFrame]

SOURCE_TABLES = ("region", "nation", "supplier", "customer", "part", "orders", "lineitem")

_models: dict[tuple, LedgerModel] = {}
_runs: dict[tuple, etl.Run] = {}


def model_key(spark: SparkSession, path: str) -> tuple:
    files = tuple(fingerprint(spark, f"{path.rstrip('/')}/{t}.parquet") for t in SOURCE_TABLES)
    return spark.sparkContext.applicationId, id(spark), path, files


def model(spark: SparkSession, path: str) -> LedgerModel:
    """The star schema of one folder, built once per session for as long as its files stay the same."""
    key = model_key(spark, path)
    if key not in _models:
        for old in [k for k in _models if k[:3] == key[:3]]:  # the files have changed: what was staged of them goes
            if old in _runs:
                _runs.pop(old).close()
            remove(spark, _models.pop(old).folder)
        _models[key] = LedgerModel(spark, path)
    return _models[key]


def run(spark: SparkSession, path: str) -> etl.Run:
    """The ETL run over the raw extracts of one folder, built once like the model; only these entries need the fixtures."""
    from fixtures.extracts import ledger_extracts

    key = model_key(spark, path)
    if key not in _runs:
        _runs[key] = etl.Run(ledger_extracts(model(spark, path)), staged=True)
    return _runs[key]


# Results that add up floating-point numbers in no fixed order are rounded; everything else is exact.
DIGITS: dict[str, dict[str, int]] = {
    **{name: {"*": 4} for name in ("plan_bridge_company", "plan_bridge_country", "plan_bridge_long", "waterfall",
                                   "yoy_lmdi_grains", "yoy_lmdi_long")},
    "anomalies": {"robust_z": 6},
    "deal_volume": {"deal_index": 6},
    "metrics_rep_ranks": {"deal_volume_index": 6},
}


def present(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Result columns as plain numbers and text: exact decimals as doubles, dates in ISO form."""
    def shown(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return F.round(c, 4).cast("double").alias(field.name)
        if isinstance(field.dataType, T.DoubleType):
            places = digits.get(field.name, digits.get("*"))
            return c if places is None else F.round(c, places).alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(field.name)
        return c

    return df.select(*[shown(f) for f in df.schema.fields])


def on_model(name: str, function, spark: SparkSession, path: str) -> DataFrame:
    return present(function(model(spark, path)), DIGITS.get(name, {}))


def on_run(name: str, function, spark: SparkSession, path: str) -> DataFrame:
    return present(function(run(spark, path)), DIGITS.get(name, {}))


# --------------------------------------------------------------------------- KPI side
TEAM_COLUMNS = ("team_key month_key year team_name country_code department_code planned_headcount active_reps "
                "ramping_reps plan allocated_target actual gross_margin commission achievement plan_achievement "
                "variance_to_target variance_to_plan capacity_gap vacant_seats commission_to_revenue ytd_actual "
                "ytd_target ytd_plan ytd_achievement mom_growth team_rank").split()

FIRST, SECOND = "country_code", "department_code"


def plan_by_month(m):
    return commission.plan_by_month(m).select("month_key", "plan_id", "plan_name", "cap_multiple_of_target",
                                              "clawback_window_days", "rep_months")


def lmdi_grains(m):
    return analysis.lmdi_bridge(commission.kpi_rep_month(m), m.policy.compare_years, (FIRST, SECOND))


def whole_bridge(m):
    return analysis.plan_bridge(kpi.team_month(m))


def country_bridge(m):
    return analysis.plan_bridge(kpi.team_month(m), [FIRST])


GRAIN_MEASURES = [n for n in (*metrics.BASES, *metrics.DERIVED)
                  if n not in ("vacant_seat_months", "ramping_rep_months", "strategic_revenue", "month_end_revenue")
                  and not any(metrics.BASES[b].fact == "rep_months" for b in metrics.bases_of([n]))]
PAY_MEASURES = ["commission", "commission_to_revenue_pct", "commissionable_base", "rep_months", "reps_paid_pct",
                "capped_rep_months", "accelerator_share_pct"]


def pay_measures(m):
    check = metrics.commission_check(m, ["year"]).select("year", "commission_check", "check_difference")
    return metrics.measure(m, PAY_MEASURES, ["year"]).join(check, "year", "full_outer")


MODEL_QUERIES: dict[str, Callable] = {
    "rep_month_base": kpi.rep_month_base,
    "rep_month_performance": kpi.rep_month_performance,
    "team_month": lambda m: kpi.team_month(m).select(*TEAM_COLUMNS),
    "country_month": lambda m: kpi.country_month(kpi.team_month(m)),
    "company_month": reports.company_trend,
    "commission_rep_month": commission.commission_rep_month,
    "commission_plan_by_month": plan_by_month,
    "uncovered_months": commission.uncovered_months,
    "plan_bridge_company": whole_bridge,
    "plan_bridge_country": country_bridge,
    "plan_bridge_long": lambda m: analysis.bridge_long(country_bridge(m), [FIRST]),
    "waterfall": lambda m: analysis.waterfall(country_bridge(m), [FIRST]),
    "yoy_lmdi_grains": lmdi_grains,
    "yoy_lmdi_long": lambda m: analysis.lmdi_long(lmdi_grains(m)),
    "anomalies": analysis.detect_anomalies,
    "declines": analysis.detect_declines,
    "scenario_sale_month": analysis.scenario_sale_month,
    "scenario_quarterly": lambda m: analysis.quarterly_pay(m).select(
        "rep_key", "year", "quarter_key", "plan_id", "tier_name", "achievement", "commission_monthly",
        "commission_quarterly"),
    "scenario_table": analysis.scenario_table,
    "scenario_summary": analysis.scenario_summary,
    "concentration": analysis.concentration,
    "deal_volume": analysis.deal_volume,
    "deal_volume_corr": analysis.deal_volume_correlation,
    "headline": analysis.headline,
    "company_rolling3": analysis.company_rolling,
    "exec_summary": reports.executive_summary,
    "country_year": reports.country_year,
    "team_year": reports.team_year,
    "rep_ytd": reports.rep_ytd,
    "statements": reports.statements,
    "statement_history": reports.statement_history,
    "statement_lines": reports.statement_lines,
    "kpi_summary": reports.kpi_summary,
    "team_cost_to_revenue": reports.team_cost,
    "country_achievement": reports.country_achievement,
    "tier_distribution": reports.tier_distribution,
    "metrics_by_grain": lambda m: metrics.measure(m, GRAIN_MEASURES, ["year", "country_name"]),
    "metrics_total": lambda m: metrics.measure(m, GRAIN_MEASURES, []),
    "metrics_by_rep": lambda m: metrics.measure(m, ["net_revenue", "target", "achievement_pct", "variance", "deals",
                                                    "achievement_status"], ["rep_key", "year"]),
    "metrics_time": lambda m: metrics.time_measures(m, ["country_name"]),
    "metrics_commission": pay_measures,
    "metrics_whatif_grid": metrics.what_if_grid,
    "metrics_capacity": lambda m: metrics.capacity_measures(m, ["year", "country_name"]),
    "metrics_rep_ranks": lambda m: metrics.rep_ranks(m, m.policy.compare_years[1]),
    "metrics_team_ranks": lambda m: metrics.place_ranks(m, ["team_name"], "team_rank"),
    "metrics_country_ranks": lambda m: metrics.place_ranks(m, ["country_name"], "country_rank"),
    "metrics_narrative": metrics.narrative,
    "metrics_rollup": metrics.drill_down,
    "metrics_matrix": metrics.month_matrix,
    "metrics_tier_mix": metrics.tier_mix,
    "reconcile_kpis": sqlviews.reconcile_kpis,
    "revenue_tie_out": sqlviews.revenue_tie_out,
    "sql_assertions": lambda m: checks.sql_assertions(m).drop("description"),
    "dq_missing_targets": lambda m: kpi.add_names(
        m.bridge.join(many(m.fact_targets.select("rep_key", "month_key")), ["rep_key", "month_key"], "left_anti"), m).select(
        "rep_key", "employee_code", "full_name", "month_key", "team_key"),
}

SAMPLE = ("line_id", "document_no", "doc_type", "date_key", "rep_key", "product_key", "net_amount_usd")

MODEL_QUERIES |= {
    "ledger_line_outcomes": lambda m: line_accounting(m.source, m.assignments, m.dim_product, m.policy),
    "seeded_sample": lambda m: io.seeded_sample(m.fact_sales, "line_id", 5000, 20240101).select(*SAMPLE),
    "first_lines": lambda m: io.first_rows(m.fact_sales, 2000, "line_id").select(*SAMPLE),
}


# --------------------------------------------------------------------------- ETL side
def standardised(r: etl.Run) -> DataFrame:
    return etl.standardise_sales(r.x.sales_lines, r.policy)


def deduped(r: etl.Run) -> DataFrame:
    return keep_first(r.x.sales_lines, ["line_id"], "copies").select("line_id", "copies", "document_no", "sku",
                                                                    "quantity", "net_amount_local")


def joined_ids(r: etl.Run) -> DataFrame:
    return r.quarantine.select("line_id", "dq_failed_rules")


def accepted(r: etl.Run) -> DataFrame:
    return r.kept.where(F.col("failed") == "")


def target_flags(r: etl.Run) -> DataFrame:
    """Every published target with its rule flags; repeats are compared with the latest revision per key."""
    flagged, _ = evaluate(r.checked_targets, etl.TARGET_RULES, r.policy)
    keys = ["rep_code", "target_month"]
    latest = r.x.sales_targets.groupBy(*keys).agg(F.max("revision_no").alias("_latest"))
    return flagged.join(many(latest), keys).select(
        F.substring("rep_code", 5, 12).try_cast("long").alias("rep_key"),
        F.regexp_replace("target_month", "-", "").cast("int").alias("month_key"), "revision_no", "target_amount_usd",
        (F.col("revision_no") < F.col("_latest")).alias("superseded"), F.col("DQ-T02").alias("not_positive"),
        F.col("DQ-T03").alias("unknown_rep"))


def calendar(r: etl.Run) -> DataFrame:
    """The days the orders span, with the documents of each day."""
    orders = r.x.orders.select(F.to_date("o_orderdate").alias("date"))
    bounds = orders.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    per_day = orders.groupBy("date").agg(F.count(F.lit(1)).alias("documents"))
    return etl.calendar(bounds, r.policy).join(per_day, "date", "left").withColumn(
        "documents", F.coalesce("documents", F.lit(0)))


RUN_QUERIES: dict[str, Callable] = {
    "std_dates": lambda r: standardised(r).select("line_id", "document_date", "fixed_date"),
    "std_country": lambda r: standardised(r).select("line_id", "country_code", "fixed_country"),
    "std_sku": lambda r: standardised(r).select("line_id", "sku", "fixed_sku"),
    "std_numeric": lambda r: standardised(r).select("line_id", "doc_type", "rep_code", "currency", "quantity",
                                                    "unit_list_price_local", "discount_pct", "net_amount_local"),
    "dq_rule_log": lambda r: r.rule_log.select("rule_id", "rows_affected", "pct_of_rows"),
    "dq_dedupe": deduped,
    "dq_quarantine": joined_ids,
    "dq_post_rules": lambda r: r.routed.where(F.col("late") & (F.col("failed") != "")).select(
        "line_id", "doc_type", "document_no", F.col("failed").alias("rule_id")),
    "dq_target_rules": target_flags,
    "row_reconciliation": lambda r: r.reconciliation,
    "integrity_checks": lambda r: checks.integrity_checks(r.model).drop("description"),
    "constraint_checks": lambda r: checks.constraint_violations(r.model).drop("description"),
    "pit_team_join": lambda r: accepted(r).where(F.col("doc_type") == "INV").select(
        "line_id", "rep_code", "document_date", "team_id"),
    "cn_original_join": lambda r: r.routed.where(F.col("late") & (F.col("doc_type") == "CN")).select(
        "line_id", "original_document_no", "team_id", "original_date",
        F.datediff("document_date", "original_date").alias("days_since_original")),
    "over_credit": lambda r: r.documents.where(F.col("credited_usd").isNotNull()).select(
        "doc", "invoiced_usd", "credited_usd", "over_credited"),
    "fx_conform": lambda r: accepted(r).select("line_id", "currency", "fx_rate", F.round(F.col("net_amount_local") / F.col("fx_rate"), 2).alias("usd")),
    "price_repair": lambda r: accepted(r).where(F.col("repair")).select("line_id", "unit_list_price_local",
                                                                       "net_amount_local"),
    "usd_economics": lambda r: r.clean.select("line_id", "gross_amount_usd", "net_amount_usd", "discount_amount_usd",
                                              "cost_amount_usd", "gross_margin_usd", "commission_weight"),
    "dim_date": calendar,
    "dim_country": lambda r: r.dim_country,
    "dim_department": lambda r: r.dim_department,
    "dim_commission_plan": lambda r: r.tiers,
    "dim_team": lambda r: r.dim_team.drop("hc_2024", "hc_2025"),
    "dim_employee": lambda r: r.dim_employee,
    "dim_product": lambda r: r.dim_product,
    "dim_customer": lambda r: r.dim_customer.drop("industry", "city", "created_date"),
    "bridge_rep_team_month": lambda r: r.bridge,
    "fact_sales": lambda r: r.fact_sales,
    "fact_targets": lambda r: r.fact_targets,
    "fact_team_plan": lambda r: r.fact_team_plan,
}


# The KPI layer on what the ETL has made of the raw extracts.
RUN_QUERIES |= {f"etl_{name}": (lambda r, f=f: f(r.model)) for name, f in {
    "rep_month_base": kpi.rep_month_base, "commission_rep_month": commission.commission_rep_month,
    "team_month": MODEL_QUERIES["team_month"], "revenue_tie_out": sqlviews.revenue_tie_out,
    "q01": questions.QUESTIONS["q01_actual_vs_target_by_year"], "q07": questions.QUESTIONS["q07_commission_by_tier"],
    "q11": questions.QUESTIONS["q11_month_end_loading"]}.items()}


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {name: partial(on_model, name, f) for name, f in questions.QUESTIONS.items()}
    out |= {name: partial(on_model, name, f) for name, f in MODEL_QUERIES.items()}
    out |= {name: partial(on_run, name, f) for name, f in RUN_QUERIES.items()}
    return out


def oracle_sql() -> dict[str, str]:
    from attain.oracle import etl as e
    from attain.oracle import insight as i
    from attain.oracle import questions as q

    plain = {**q.statements(), **e.statements(), **i.statements()}
    return {**plain, **e.on_the_run({**q.SQL, **i.SQL})}

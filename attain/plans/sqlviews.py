"""A second implementation of the rep-month KPIs and commission, written as Spark SQL.

It shares no code with the DataFrame version; the two are reconciled row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attain.operators.checks import reconcile
from attain.operators.joins import many
from attain.plans.kpi import rank_in_team
from attain.plans.commission import kpi_rep_month
from attain.plans.model import Model, view

REP_MONTHS = """
WITH sold AS (
    SELECT s.rep_key, s.month_key, SUM(net_amount_usd) AS revenue,
           SUM(IF(doc_type = 'INV' OR days_since_original <= w.clawback_window_days,
                  net_amount_usd * commission_weight, 0)) AS weighted
      FROM {sales} s LEFT JOIN {plans} w ON w.month_key = s.month_key
     GROUP BY s.rep_key, s.month_key),
spine AS (
    SELECT b.rep_key, b.month_key, b.team_key, b.month_key DIV 100 AS year, t.target_amount_usd AS target,
           COALESCE(s.revenue, 0) AS actual, COALESCE(s.weighted, 0) AS weighted
      FROM {bridge} b
      LEFT JOIN {targets} t ON t.rep_key = b.rep_key AND t.month_key = b.month_key
      LEFT JOIN sold s ON s.rep_key = b.rep_key AND s.month_key = b.month_key),
trend AS (
    SELECT *, try_divide(CAST(actual AS DOUBLE), CAST(target AS DOUBLE)) AS achievement,
           SUM(actual) OVER (PARTITION BY rep_key, year ORDER BY month_key
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ytd_actual,
           try_divide(CAST(SUM(actual) OVER last3 AS DOUBLE), CAST(SUM(target) OVER last3 AS DOUBLE))
               AS rolling_3m_achievement
      FROM spine
    WINDOW last3 AS (PARTITION BY rep_key ORDER BY month_key ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
priced AS (
    SELECT t.*, p.plan_id, IF(target IS NULL OR p.plan_id IS NULL, 0, LEAST(GREATEST(weighted, 0), p.cap_multiple_of_target * target)) AS base
      FROM trend t LEFT JOIN {plans} p ON p.month_key = t.month_key)
SELECT x.rep_key, x.month_key, x.team_key, x.actual, x.ytd_actual, x.rolling_3m_achievement, x.achievement,
       IF(x.plan_id IS NULL, 'No Plan', COALESCE(b.tier_name, 'No Target')) AS tier_name,
       CAST(x.base AS DECIMAL(24, 4)) * COALESCE(b.commission_rate, 0) AS commission
  FROM priced x
  LEFT JOIN {bands} b ON b.plan_id = x.plan_id AND x.achievement >= COALESCE(b.band_floor, x.achievement)
                     AND (b.band_ceiling IS NULL OR x.achievement < b.band_ceiling)
"""

TOLERANCES = {"actual": 0.01, "ytd_actual": 0.01, "rolling_3m_achievement": 1e-9, "rank_in_team": None,
              "tier_name": None, "commission": 0.01}


@view
def sql_rep_months(m: Model) -> DataFrame:
    return m.spark.sql(REP_MONTHS, sales=m.fact_sales, plans=m.plan_months, bridge=m.bridge, targets=many(m.fact_targets),
                       bands=m.tier_bands)


def reconcile_kpis(m: Model) -> DataFrame:
    """Seven checks of the two implementations against each other."""
    left, right = rank_in_team(kpi_rep_month(m)), rank_in_team(sql_rep_months(m))
    return reconcile(left, right, ["rep_key", "month_key"], TOLERANCES, total="commission", nodes=["team_key", "month_key"])


def revenue_tie_out(m: Model) -> DataFrame:
    """Fact revenue, team revenue and rep revenue per year. Rep revenue lacks the credit notes posted
    outside active rep-months; team revenue must equal the fact."""
    from attain.functions import columns as C
    from attain.plans.kpi import team_month

    year = C.year_of("month_key").alias("year")
    fact = m.fact_sales.groupBy(year).agg(F.sum("net_amount_usd").alias("fact_revenue"))
    team = team_month(m).groupBy("year").agg(F.sum("actual").alias("team_revenue"))
    rep = kpi_rep_month(m).groupBy("year").agg(F.sum("actual").alias("rep_revenue"))
    return fact.join(team, "year", "full_outer").join(rep, "year", "full_outer").withColumn(
        "ties", F.abs(F.col("fact_revenue") - F.col("team_revenue")) < 1)

"""The data behind the management pack, the statements and the charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attain.functions import columns as C
from attain.operators.joins import one_row
from attain.operators.ranking import group_rank
from attain.plans.commission import commission_rep_month, kpi_rep_month
from attain.plans.kpi import company_month, country_month, team_month
from attain.plans.model import Model
from attain.plans.questions import country_gap, team_status
from attain.policy import NO_TARGET

YEAR_SUMS = ("plan", "allocated_target", "actual", "commission")


def executive_summary(m: Model) -> DataFrame:
    """Six company figures for the two comparison years, one row per figure."""
    years = m.policy.compare_years
    rep = kpi_rep_month(m)

    def of(column: str, year: int):
        return F.sum(F.when(F.col("year") == year, F.col(column)))

    t = team_month(m).agg(*[of(c, y).alias(f"{c}_{y}") for c in ("actual", "allocated_target") for y in years])
    r = rep.agg(*[of(c, y).alias(f"rep_{c}_{y}") for c in ("actual", "commission") for y in years])
    figures = [
        ("Net revenue (USD)", lambda y: C.usd(f"actual_{y}")),
        ("Allocated target (USD)", lambda y: C.usd(f"allocated_target_{y}")),
        ("Achievement", lambda y: F.round(C.ratio(f"actual_{y}", f"allocated_target_{y}"), 3)),
        ("Variance to target (USD)", lambda y: C.usd(F.col(f"actual_{y}") - F.col(f"allocated_target_{y}"))),
        ("Commission (USD)", lambda y: C.usd(f"rep_commission_{y}")),
        ("Commission / revenue", lambda y: F.round(C.ratio(f"rep_commission_{y}", f"rep_actual_{y}"), 4)),
    ]
    rows = F.array(*[F.struct(F.lit(label).alias("kpi"), value(years[0]).alias(f"fy{years[0]}"),
                              value(years[1]).alias(f"fy{years[1]}")) for label, value in figures])
    return one_row(t, r).select(F.explode(rows).alias("_k")).select("_k.*")


def per_year(df: DataFrame, *keys: str) -> DataFrame:
    g = df.groupBy(*keys, "year").agg(*[F.sum(c).alias(c) for c in YEAR_SUMS])
    return g.select("*", C.ratio("actual", "allocated_target").alias("achievement"),
                    C.ratio("actual", "plan").alias("plan_achievement"),
                    (F.col("actual") - F.col("allocated_target")).alias("variance_to_target"))


def country_year(m: Model) -> DataFrame:
    return per_year(country_month(team_month(m)), "country_code")


def team_year(m: Model) -> DataFrame:
    return per_year(team_month(m), "team_name").drop("plan_achievement").orderBy("year", F.desc("achievement"))


def rep_ytd(m: Model) -> DataFrame:
    """Reps of the latest year with their rank; revenue of all months over the targets there are."""
    rep = kpi_rep_month(m)
    latest = rep.agg(F.max("year")).scalar()
    g = (rep.where(F.col("year") == latest).groupBy("employee_code", "full_name", "team_name")
         .agg(F.count(F.lit(1)).alias("months"), F.sum("target").alias("target"), F.sum("actual").alias("actual"),
              F.sum("deals").alias("deals"), F.sum("commission").alias("commission"))
         .withColumn("achievement", C.ratio("actual", "target")))
    return group_rank(g, [], "achievement", rank="rank")


def statement_reps(m: Model) -> DataFrame:
    """Rep-months that get a statement: the statement month, with a target."""
    return kpi_rep_month(m).where((F.col("month_key") == m.policy.statement_month) & F.col("target").isNotNull())


def statements(m: Model) -> DataFrame:
    """One statement per rep, recomputed from its parts and checked against the priced commission."""
    month = m.policy.statement_month
    ytd = (kpi_rep_month(m).where(F.col("year") == month // 100).groupBy("rep_key")
           .agg(F.sum("commission").alias("ytd_commission")))
    base = (F.col("weighted_invoiced") + F.col("weighted_clawback")).cast(C.WEIGHTED)
    capped = F.least(F.greatest(base, F.lit(0).cast(C.WEIGHTED)), F.col("cap_amount"))
    payable = F.round(F.col("capped_base") * F.col("commission_rate"), 2)
    return (statement_reps(m).join(ytd, "rep_key").withColumn("base", base).withColumn("capped_base", capped)
            .withColumn("payable", payable)
            .select("employee_code", "full_name", "team_name", "plan_id", "month_key", "target", "actual", "achievement",
                    "tier_name", "commission_rate", "weighted_invoiced", "weighted_clawback",
                    F.col("base").alias("weighted_base"), "cap_amount", F.col("capped_base").alias("commissionable_base"),
                    F.col("payable").alias("commission_payable"), "ytd_commission",
                    F.round(F.col("payable") - F.round("commission", 2), 2).alias("check_value")))


def statement_history(m: Model) -> DataFrame:
    """The year's months of every rep with a statement: one row per rep and month."""
    year = m.policy.statement_month // 100
    listed = statement_reps(m).select("rep_key")
    return (kpi_rep_month(m).where(F.col("year") == year).join(listed, "rep_key", "left_semi")
            .select("employee_code", "month_key", "target", "actual", "achievement", "tier_name", "commission"))


def statement_lines(m: Model) -> DataFrame:
    """Transactions behind the statements: one row per line, so a busy rep is never gathered in one place."""
    reps = statement_reps(m).select("rep_key", "employee_code")
    products = m.dim_product.select("product_key", F.col("product_name").alias("product"))
    customers = m.dim_customer.select("customer_key", F.col("customer_name").alias("customer"))
    return (m.fact_sales.where(F.col("month_key") == m.policy.statement_month)
            .join(reps, "rep_key").join(products, "product_key", "left").join(customers, "customer_key", "left")
            .select("employee_code", "line_id", "document_no", "doc_type", "date_key", "customer", "product", "quantity",
                    "discount_pct", "net_amount_usd", "commission_weight", "days_since_original"))


def kpi_summary(m: Model) -> DataFrame:
    """Country gaps and team standings in one long list."""
    countries = country_gap(m).select(
        F.lit("country").alias("section"), F.col("country_name").alias("name"), "year", "achievement_pct",
        "execution_gap_usd", "capacity_gap_usd", F.lit(None).cast("string").alias("status"))
    teams = team_status(m).select(
        F.lit("team").alias("section"), F.col("team_name").alias("name"), "year", "achievement_pct",
        F.lit(None).cast("double").alias("execution_gap_usd"), F.lit(None).cast("double").alias("capacity_gap_usd"),
        "status")
    return countries.unionByName(teams)


def team_cost(m: Model) -> DataFrame:
    """Commission as a share of revenue per team over all years."""
    return (team_month(m).groupBy("team_name").agg(F.sum("commission").alias("commission"), F.sum("actual").alias("actual"))
            .withColumn("rate_pct", 100 * C.ratio("commission", "actual")).orderBy("rate_pct"))


def country_achievement(m: Model) -> DataFrame:
    """Achievement per country for both comparison years, weakest latest year first."""
    y0, y1 = m.policy.compare_years

    def of(year: int):
        rows = F.col("year") == year
        return 100 * C.ratio(F.sum(F.when(rows, F.col("actual"))), F.sum(F.when(rows, F.col("allocated_target"))))

    return (country_month(team_month(m)).groupBy("country_code")
            .agg(of(y0).alias(f"achievement_{y0}_pct"), of(y1).alias(f"achievement_{y1}_pct"))
            .orderBy(f"achievement_{y1}_pct"))


def tier_distribution(m: Model) -> DataFrame:
    """Rep-months per tier as a share of all rep-months of the plan; rep-months without target are not shown."""
    g = commission_rep_month(m).groupBy("plan_id", "tier_name").agg(F.count(F.lit(1)).alias("rep_months"))
    share = C.pct("rep_months", F.sum("rep_months").over(W.partitionBy("plan_id")))
    return g.withColumn("pct_of_rep_months", share).where(F.col("tier_name") != NO_TARGET)


def company_trend(m: Model) -> DataFrame:
    return company_month(team_month(m))

"""KPI layer: rep, team, country and company months.

Line-grain facts are read once and reduced to (rep, month) before they meet the spine of active
rep-months; everything after that works on pre-aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attain.functions import columns as C
from attain.operators.joins import many
from attain.operators.ranking import group_rank
from attain.plans.model import Model, view


DRIVERS = ("actual", "invoiced_revenue", "credit_notes", "gross_list_value", "discount_value", "gross_margin",
           "month_end_revenue", "strategic_revenue")


def rep_month_sales(m: Model) -> DataFrame:
    """Net revenue, its drivers and the weighted pay inputs per rep and month, in one pass over the lines.

    Lines are dealt by rep and month once; documents are told apart and counted where the lines then are. Combining before
    the shuffle would save nothing, as a rep has few lines of a document, and would shuffle every document twice.
    """
    inv = F.col("doc_type") == "INV"
    windows = m.plan_months.select("month_key", "clawback_window_days")
    lines = m.fact_sales.select(
        "rep_key", "month_key", "doc_type", F.when(inv, F.col("document_no")).alias("document_no"), "net_amount_usd",
        F.when(inv, F.col("gross_amount_usd")).alias("gross_amount_usd"), F.when(inv, F.col("discount_amount_usd")).alias("discount_amount_usd"),
        "gross_margin_usd", "commission_weight", "days_since_original", "is_month_end_window").repartition("rep_key", "month_key")
    return lines.join(windows, "month_key", "left").groupBy("rep_key", "month_key").agg(
        C.total("net_amount_usd").alias("actual"),
        C.total("net_amount_usd", inv).alias("invoiced_revenue"),
        C.total("net_amount_usd", ~inv).alias("credit_notes"),
        C.total("gross_amount_usd", inv).alias("gross_list_value"),
        C.total("discount_amount_usd", inv).alias("discount_value"),
        C.total("gross_margin_usd").alias("gross_margin"),
        F.count_distinct(F.when(inv, F.col("document_no"))).alias("deals"),
        C.total("net_amount_usd", inv & (F.col("is_month_end_window") == 1)).alias("month_end_revenue"),
        C.total("net_amount_usd", inv & (F.col("commission_weight") > 1)).alias("strategic_revenue"),
        *pay_inputs())


def pay_inputs() -> list:
    """Weighted invoices, weighted credit notes inside the clawback window, and those outside it."""
    inv = F.col("doc_type") == "INV"
    weighted = F.col("net_amount_usd") * F.col("commission_weight")
    recent = ~inv & (F.col("days_since_original") <= F.col("clawback_window_days"))
    late = ~inv & (F.col("days_since_original") > F.col("clawback_window_days"))
    return [
        C.total(weighted, inv, 4, C.WEIGHTED).alias("weighted_invoiced"),
        C.total(weighted, recent, 4, C.WEIGHTED).alias("weighted_clawback"),
        C.total("net_amount_usd", late).alias("credit_notes_outside_window"),
    ]


@view(stage=["month_key"])
def rep_month_base(m: Model) -> DataFrame:
    """One row per active rep-month, whether or not anything was sold."""
    teams = m.dim_team.select("team_key", "team_name", "country_code", "department_code")
    targets = m.fact_targets.select("rep_key", "month_key", F.col("target_amount_usd").alias("target"))
    money = [F.coalesce(c, F.lit(0).cast(C.SUM_MONEY)).alias(c) for c in (*DRIVERS, "credit_notes_outside_window")]
    weighted = [F.coalesce(c, F.lit(0).cast(C.WEIGHTED)).alias(c) for c in ("weighted_invoiced", "weighted_clawback")]
    return (m.bridge.join(many(targets), ["rep_key", "month_key"], "left")
            .join(many(rep_month_sales(m)), ["rep_key", "month_key"], "left")
            .join(teams, "team_key")
            .select("rep_key", "month_key", "team_key", "team_name", "country_code", "department_code",
                    "tenure_months", "is_ramp_month", "target", *money, *weighted,
                    F.coalesce("deals", F.lit(0)).cast("long").alias("deals")))


def add_ratios(base: DataFrame) -> DataFrame:
    return base.select(
        "*", C.year_of("month_key").alias("year"), C.ratio("actual", "target").alias("achievement"),
        (F.col("actual") - F.col("target")).alias("variance"),
        C.ratio("discount_value", "gross_list_value").alias("discount_rate"),
        C.ratio("invoiced_revenue", "deals").alias("avg_deal_size"),
        C.ratio(-F.col("credit_notes"), "invoiced_revenue").alias("credit_note_rate"),
        C.ratio("month_end_revenue", "invoiced_revenue").alias("month_end_share"),
        C.ratio("strategic_revenue", "invoiced_revenue").alias("strategic_mix"),
        C.ratio("gross_margin", "actual").alias("gross_margin_pct"))


def running(keys: list[str], order: list[str]):
    """Calendar-ordered windows sharing one sort: whole history and year to date."""
    history = W.partitionBy(*keys).orderBy(*order)
    to_date = W.partitionBy(*keys, "year").orderBy(*order)
    return history, to_date.rowsBetween(W.unboundedPreceding, W.currentRow)


@view
def rep_month_trend(m: Model) -> DataFrame:
    """Ratios, month-on-month growth, year to date and rolling three months per rep."""
    history, ytd = running(["rep_key"], ["year", "month_key"])
    last3 = history.rowsBetween(-2, W.currentRow)
    prev = F.col("_prev")
    staged = add_ratios(rep_month_base(m)).select(
        "*", F.lag("actual").over(history).alias("_prev"),
        F.sum("actual").over(ytd).alias("ytd_actual"), F.sum("target").over(ytd).alias("ytd_target"),
        F.sum("actual").over(last3).alias("_r3_actual"), F.sum("target").over(last3).alias("_r3_target"))
    return staged.select(
        "*", C.ratio(F.col("actual") - prev, prev).alias("mom_growth"),
        C.ratio("ytd_actual", "ytd_target").alias("ytd_achievement"),
        C.ratio("_r3_actual", "_r3_target").alias("rolling_3m_achievement"),
        C.performance_band(F.col("achievement"), F.col("target")).alias("performance_band"),
    ).drop("_prev", "_r3_actual", "_r3_target")


def add_names(df: DataFrame, m: Model) -> DataFrame:
    names = m.dim_employee.select(F.col("employee_key").alias("rep_key"), "employee_code", "full_name")
    return df.join(names, "rep_key")


def rank_in_team(df: DataFrame) -> DataFrame:
    """Rank within team and month by achievement: as many rows as a team has seats, so a window ranks them."""
    in_team = W.partitionBy("team_key", "month_key").orderBy(F.desc_nulls_last("achievement"))
    return df.withColumn("rank_in_team", F.when(F.col("achievement").isNotNull(), F.rank().over(in_team)).cast("long"))


@view
def rep_month_performance(m: Model) -> DataFrame:
    """The rep-month view with names and ranks within team and company (which has no bound on its rows)."""
    return add_names(group_rank(rank_in_team(rep_month_trend(m)), ["month_key"], "achievement", rank="rank_in_company"), m)


# --------------------------------------------------------------------------- team, country, company
@view(stage=["month_key"])
def team_month(m: Model) -> DataFrame:
    """Plan, allocated target, revenue by team at time of sale, headcount and pay per team and month."""
    from attain.plans.commission import commission_rep_month

    keys = ["team_key", "month_key"]
    revenue = m.fact_sales.groupBy(*keys).agg(C.total("net_amount_usd").alias("actual"),
                                              C.total("gross_margin_usd").alias("gross_margin"))
    target = m.fact_targets.groupBy(*keys).agg(F.sum("target_amount_usd").alias("allocated_target"))
    seats = m.bridge.groupBy(*keys).agg(F.count(F.lit(1)).alias("active_reps"),
                                        F.sum("is_ramp_month").alias("ramping_reps"))
    pay = commission_rep_month(m).groupBy(*keys).agg(F.sum("commission").alias("commission"))
    teams = m.dim_team.select("team_key", "team_name", "country_code", "department_code")
    joined = (m.fact_team_plan.select(*keys, "planned_headcount", F.col("plan_amount_usd").alias("plan"))
              .join(teams, "team_key").join(revenue, keys, "left").join(target, keys, "left")
              .join(seats, keys, "left").join(pay, keys, "left"))
    rows = joined.select(
        *keys, C.year_of("month_key").alias("year"), "team_name", "country_code", "department_code",
        "planned_headcount", F.coalesce("active_reps", F.lit(0)).alias("active_reps"),
        F.coalesce("ramping_reps", F.lit(0)).alias("ramping_reps"), "plan",
        *[F.coalesce(c, F.lit(0).cast(C.SUM_MONEY)).alias(c) for c in ("allocated_target", "actual", "gross_margin")],
        F.coalesce("commission", F.lit(0).cast("decimal(38,8)")).alias("commission"))
    history, ytd = running(["team_key"], ["year", "month_key"])
    staged = rows.select(
        "*", F.lag("actual").over(history).alias("_prev"), F.sum("actual").over(ytd).alias("ytd_actual"),
        F.sum("allocated_target").over(ytd).alias("ytd_target"), F.sum("plan").over(ytd).alias("ytd_plan"))
    out = staged.select(
        "*", C.ratio("actual", "allocated_target").alias("achievement"),
        C.ratio("actual", "plan").alias("plan_achievement"),
        (F.col("actual") - F.col("allocated_target")).alias("variance_to_target"),
        (F.col("actual") - F.col("plan")).alias("variance_to_plan"),
        (F.col("plan") - F.col("allocated_target")).alias("capacity_gap"),
        F.greatest(F.col("planned_headcount") - F.col("active_reps"), F.lit(0)).cast("long").alias("vacant_seats"),
        C.ratio("ytd_actual", "ytd_target").alias("ytd_achievement"),
        C.ratio(F.col("actual") - F.col("_prev"), "_prev").alias("mom_growth"),
        C.ratio("commission", "actual").alias("commission_to_revenue")).drop("_prev")
    return bounded_dense_rank(out, ["month_key"], "achievement", "team_rank")


def bounded_dense_rank(df: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """Dense rank of one row per team or country and month, null values unranked.

    Only used where the group is a list of teams or countries, which does not grow with the facts.
    """
    w = W.partitionBy(*by).orderBy(F.desc_nulls_last(value))
    return df.withColumn(name, F.when(F.col(value).isNotNull(), F.dense_rank().over(w)))


def country_month(team: DataFrame) -> DataFrame:
    sums = ["plan", "allocated_target", "actual", "gross_margin", "active_reps", "planned_headcount", "commission"]
    rows = team.groupBy("country_code", "month_key", "year").agg(*[F.sum(c).alias(c) for c in sums])
    history, ytd = running(["country_code"], ["year", "month_key"])
    staged = rows.select("*", F.lag("actual").over(history).alias("_prev"),
                         F.sum("actual").over(ytd).alias("_ytd"), F.sum("allocated_target").over(ytd).alias("_ytd_t"))
    out = staged.select(
        *rows.columns, C.ratio("actual", "allocated_target").alias("achievement"),
        C.ratio("actual", "plan").alias("plan_achievement"),
        (F.col("actual") - F.col("allocated_target")).alias("variance_to_target"),
        (F.col("actual") - F.col("plan")).alias("variance_to_plan"),
        C.ratio("_ytd", "_ytd_t").alias("ytd_achievement"),
        C.ratio(F.col("actual") - F.col("_prev"), "_prev").alias("mom_growth"))
    return bounded_dense_rank(out, ["month_key"], "achievement", "country_rank")


def company_month(team: DataFrame) -> DataFrame:
    """One row per calendar month: the windows below run over months only."""
    sums = {"plan": "plan", "allocated_target": "target", "actual": "actual", "gross_margin": "gross_margin",
            "active_reps": "active_reps"}
    rows = (team.groupBy("month_key", "year").agg(*[F.sum(c).alias(n) for c, n in sums.items()])
            .withColumn("_all", F.lit(0)))
    history, ytd = running(["_all"], ["year", "month_key"])
    last3 = history.rowsBetween(-2, W.currentRow)
    staged = rows.select(
        "*", F.lag("actual").over(history).alias("_prev"), F.lag("actual", 12).over(history).alias("_year_ago"),
        F.sum("actual").over(last3).alias("_r3"), F.sum("target").over(last3).alias("_r3_target"),
        F.count(F.lit(1)).over(last3).alias("_n3"),
        F.sum("actual").over(ytd).alias("ytd_actual"), F.sum("target").over(ytd).alias("ytd_target"))
    return staged.select(
        "month_key", "year", *sums.values(), C.ratio("actual", "target").alias("achievement"),
        (F.col("actual") - F.col("target")).alias("variance"),
        C.ratio(F.col("actual") - F.col("_prev"), "_prev").alias("mom_growth"),
        C.ratio(F.col("actual") - F.col("_year_ago"), "_year_ago").alias("yoy_growth"),
        C.ratio("_r3", "_n3").alias("actual_3m_avg"), "ytd_actual", "ytd_target",
        F.when(F.col("_n3") == 3, C.ratio("_r3", "_r3_target")).alias("rolling_3m_achievement"))

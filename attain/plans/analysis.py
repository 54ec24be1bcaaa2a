"""Variance bridges, anomalies, declines, pay scenarios, concentration and headline figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attain.functions import columns as C
from attain.operators.joins import band_join, one_row
from attain.operators.keys import Bitmap
from attain.operators.ranking import top_rows
from attain.plans.commission import add_commission, capped_base, commission_rep_month, kpi_rep_month
from attain.plans.kpi import company_month, rep_month_base, team_month
from attain.plans.model import Model

BRIDGE_STEPS = (("1 Capacity plan", "plan"), ("2 Vacant seats", "vacancy_effect"),
                ("3 Ramp & other", "ramp_and_other_effect"), ("4 Execution", "execution_effect"))
LMDI_FACTORS = (("headcount_effect", "rep_months"), ("deal_volume_effect", "deals_per_rm"),
                ("deal_size_effect", "gross_per_deal"), ("discount_effect", "realisation"),
                ("credit_note_effect", "retention"))


# --------------------------------------------------------------------------- bridges
def plan_bridge(team: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Capacity plan to actual: vacant seats, ramp and other, execution. The effects add up exactly."""
    seat_quota = C.ratio("plan", "planned_headcount")
    g = (team.withColumn("_vacancy", -F.col("vacant_seats") * seat_quota).groupBy("year", *(by or []))
         .agg(F.sum("plan").alias("plan"), F.coalesce(F.sum("_vacancy"), F.lit(0.0)).alias("vacancy_effect"),
              F.sum("allocated_target").alias("allocated_target"), F.sum("actual").alias("actual")))
    plan, target, actual = (F.col(c).cast("double") for c in ("plan", "allocated_target", "actual"))
    out = g.select("year", *(by or []), plan.alias("plan"), "vacancy_effect", target.alias("allocated_target"),
                   actual.alias("actual"),
                   (target - plan - F.col("vacancy_effect")).alias("ramp_and_other_effect"),
                   (actual - target).alias("execution_effect"))
    explained = F.col("plan") + F.col("vacancy_effect") + F.col("ramp_and_other_effect") + F.col("execution_effect")
    return out.withColumn("residual", explained - F.col("actual"))


def bridge_long(bridge: DataFrame, by: list[str]) -> DataFrame:
    """One row per step of a plan bridge."""
    labels = {column: label for label, column in BRIDGE_STEPS}
    long = bridge.unpivot(["year", *by], [c for _, c in BRIDGE_STEPS], "measure", "amount_usd")
    names = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return long.select("year", *by, names[F.col("measure")].alias("step"), "amount_usd")


def waterfall(bridge: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Base and height of every bar from plan over the deltas to actual."""
    keys = ["year", *(by or [])]
    steps = list(BRIDGE_STEPS) + [("5 Actual", "actual")]
    bars = F.explode(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(label).alias("step"),
                                        F.col(column).alias("amount"), F.lit(i in (0, 4)).alias("is_total"))
                               for i, (label, column) in enumerate(steps)]))
    rows = bridge.select(*keys, bars.alias("_b")).select(*keys, "_b.*")
    until = W.partitionBy(*keys).orderBy("position").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.when(F.col("position") == 4, F.col("amount")).otherwise(F.sum("amount").over(until))
    base = F.when(F.col("is_total"), F.lit(0.0)).otherwise(F.least(F.col("_end"), F.col("_end") - F.col("amount")))
    height = F.when(F.col("is_total"), F.col("amount")).otherwise(F.abs("amount"))
    return rows.withColumn("_end", end).select(*keys, "step", "is_total", "amount", base.alias("bar_base"),
                                               height.alias("bar_height"))


def log_mean(a: Column, b: Column) -> Column:
    """Logarithmic mean; null unless both sides are positive."""
    positive = (a > 0) & (b > 0)
    return F.when(positive & (a == b), a).when(positive, (a - b) / (F.ln(a) - F.ln(b)))


def lmdi_bridge(rep: DataFrame, years: tuple[int, int], grains: tuple[str, ...] = ()) -> DataFrame:
    """Revenue change between two years split into five factors, for the company and every grain in one pass.

    Rep-months are reduced to (year, grains) before the grouping sets multiply them.
    """
    y0, y1 = years
    dims = list(grains)
    parts = ("rep_months", "deals", "gross", "invoiced", "net")
    cells = (rep.where(F.col("year").isin(y0, y1)).groupBy("year", *dims)
             .agg(F.count(F.lit(1)).alias("rep_months"), F.sum("deals").alias("deals"),
                  F.sum("gross_list_value").alias("gross"), F.sum("invoiced_revenue").alias("invoiced"),
                  F.sum("actual").alias("net")))
    sums = [F.sum(F.when(F.col("year") == y, F.col(p))).cast("double").alias(f"{p}_{i}")
            for p in parts for i, y in enumerate((y0, y1))]
    if dims:
        sets = [[]] + [[F.col(d)] for d in dims]
        g = cells.groupingSets(sets, *[F.col(d) for d in dims]).agg(*sums, F.grouping_id().alias("_level"))
        company = 2 ** len(dims) - 1
        grain, group = F.when(F.col("_level") == company, "company"), F.when(F.col("_level") == company, "Company")
        for i, d in enumerate(dims):
            level = company - 2 ** (len(dims) - 1 - i)
            grain, group = grain.when(F.col("_level") == level, d), group.when(F.col("_level") == level, F.col(d))
        g = g.select(grain.alias("grain"), group.alias("group"), *[f"{p}_{i}" for p in parts for i in (0, 1)])
    else:
        g = cells.agg(*sums).select(F.lit("company").alias("grain"), F.lit("Company").alias("group"), "*")
    for i in (0, 1):
        g = g.withColumns({f"deals_per_rm_{i}": C.ratio(f"deals_{i}", f"rep_months_{i}"),
                           f"gross_per_deal_{i}": C.ratio(f"gross_{i}", f"deals_{i}"),
                           f"realisation_{i}": C.ratio(f"invoiced_{i}", f"gross_{i}"),
                           f"retention_{i}": C.ratio(f"net_{i}", f"invoiced_{i}")})
    weight = log_mean(F.col("net_1"), F.col("net_0"))

    def effect(column: str) -> Column:
        a, b = F.col(f"{column}_1"), F.col(f"{column}_0")
        return F.when((a > 0) & (b > 0), weight * F.ln(a / b))

    out = g.select("grain", "group", F.col("net_0").alias(f"revenue_{y0}"), F.col("net_1").alias(f"revenue_{y1}"),
                   (F.col("net_1") - F.col("net_0")).alias("change"),
                   *[effect(column).alias(name) for name, column in LMDI_FACTORS],
                   (1 - F.col("realisation_0")).alias(f"discount_rate_{y0}"),
                   (1 - F.col("realisation_1")).alias(f"discount_rate_{y1}"),
                   F.col("deals_per_rm_0").alias(f"deals_per_rm_{y0}"),
                   F.col("deals_per_rm_1").alias(f"deals_per_rm_{y1}"))
    explained = sum((F.col(name) for name, _ in LMDI_FACTORS), F.lit(0.0))
    return out.withColumn("residual", explained - F.col("change"))


def lmdi_long(bridge: DataFrame) -> DataFrame:
    return bridge.unpivot(["grain", "group"], [name for name, _ in LMDI_FACTORS], "driver", "amount_usd")


# --------------------------------------------------------------------------- anomalies and declines
def settled(rep: DataFrame) -> DataFrame:
    return rep.where(F.col("target").isNotNull() & (F.col("is_ramp_month") == 0))


def detect_anomalies(m: Model) -> DataFrame:
    """Rep-months far from the rep's own median, in units of the median absolute deviation."""
    p, own = m.policy, W.partitionBy("rep_key")
    r = settled(kpi_rep_month(m)).withColumn("_med", F.median("achievement").over(own))
    r = r.withColumn("_mad", F.median(F.abs(F.col("achievement") - F.col("_med"))).over(own))
    z = C.ratio(F.lit(0.6745) * (F.col("achievement") - F.col("_med")), "_mad")
    kind = F.when(F.col("robust_z") >= p.anomaly_mad, "Spike").when(F.col("robust_z") <= -p.anomaly_mad, "Drop")
    loaded = (F.col("anomaly_type") == "Spike") & (F.col("month_end_share") >= p.month_end_share)
    return (r.withColumn("robust_z", z).withColumn("anomaly_type", kind).where(F.col("anomaly_type").isNotNull())
            .withColumn("month_end_share", F.round("month_end_share", 3))
            .select("employee_code", "full_name", "team_name", "month_key", "target", "actual", "achievement",
                    "robust_z", "anomaly_type", "month_end_share", "tier_name", "commission",
                    F.when(loaded, "Spike concentrated in month-end window").otherwise("")
                    .alias("revenue_quality_flag")))


def detect_declines(m: Model) -> DataFrame:
    """Reps active in the last month whose rolling achievement fell steadily over their last months."""
    p = m.policy
    rep = kpi_rep_month(m)
    last = rep.agg(F.max("month_key")).scalar()
    recent = W.partitionBy("rep_key").orderBy(F.desc("month_key"))
    rows = settled(rep).withColumn("rn", F.row_number().over(recent)).where(F.col("rn") <= p.decline_months)
    pct = 100 * F.col("rolling_3m_achievement")
    newest, oldest = F.col("rn") == 1, F.col("rn") == p.decline_months
    g = (rows.groupBy("rep_key", "employee_code", "full_name")
         .agg(F.count(F.lit(1)).alias("_n"), F.max("month_key").alias("_last"),
              F.regr_slope(pct, F.lit(p.decline_months).cast("double") - F.col("rn")).alias("slope"),
              F.max(F.when(oldest, F.col("team_name"))).alias("team_name"),
              F.max(F.when(oldest, pct)).alias("first_pct"), F.max(F.when(newest, pct)).alias("last_pct"),
              F.max(F.when(newest, F.col("ytd_achievement"))).alias("ytd")))
    return (g.where((F.col("_n") == p.decline_months) & (F.col("_last") == last) & (F.col("slope") <= p.decline_slope)
                    & (F.col("last_pct") / 100 <= p.decline_latest))
            .select("employee_code", "full_name", "team_name", F.round("slope", 1).alias("slope_pp_per_month"),
                    F.round("first_pct", 1).alias("rolling_3m_6_months_ago_pct"),
                    F.round("last_pct", 1).alias("rolling_3m_latest_pct"),
                    F.round(100 * F.col("ytd"), 1).alias("ytd_achievement_pct")))


# --------------------------------------------------------------------------- pay scenarios
def moved_credit_notes(m: Model) -> DataFrame:
    """What booking clawbacks to the month of sale changes, per rep and month: net amount and weighted clawback.

    A credit note inside the clawback window of its month leaves that month and comes to the month of its invoice, where it
    is weighted only if it lies inside the window of that month too. Without that invoice it has no month and drops out; the
    checks IC-10 and A04 count such notes, and the job stops on them before. Only invoices that such notes refer to are
    grouped.
    """
    inv, net = F.col("doc_type") == "INV", F.col("net_amount_usd")
    windows = m.plan_months.select("month_key", "clawback_window_days")
    notes = (m.fact_sales.where(~inv).join(windows, "month_key").where(F.col("days_since_original") <= F.col("clawback_window_days"))
             .select("rep_key", "month_key", "original_document_no", "days_since_original", net.alias("net"),
                     (net * F.col("commission_weight")).alias("weighted")))
    referred = Bitmap(notes.select(F.xxhash64("original_document_no").alias("h")))
    booked = (referred.among(m.fact_sales.where(inv).select("document_no", F.col("month_key").alias("sale_month"), F.xxhash64("document_no").alias("h")))
              .groupBy(F.col("document_no").alias("original_document_no")).agg(F.min("sale_month").alias("sale_month")))
    later = windows.select(F.col("month_key").alias("sale_month"), F.col("clawback_window_days").alias("sale_window"))
    moved = (notes.join(booked, "original_document_no", "left").where(~F.col("sale_month").eqNullSafe(F.col("month_key")))
             .join(later, "sale_month", "left"))
    weighted = F.when(F.col("days_since_original") <= F.col("sale_window"), F.col("weighted")).otherwise(F.lit(0))
    sides = F.array(F.struct("month_key", (-F.col("net")).alias("net"), (-F.col("weighted")).alias("weighted")),
                    F.struct(F.col("sale_month").alias("month_key"), F.col("net"), weighted.alias("weighted")))
    return (moved.select("rep_key", F.explode(sides).alias("_s")).select("rep_key", "_s.*").where("month_key IS NOT NULL")
            .groupBy("rep_key", "month_key").agg(C.total("net").alias("net"), C.total("weighted", None, 4, C.WEIGHTED).alias("weighted")))


def scenario_sale_month(m: Model) -> DataFrame:
    """Commission per year as paid and with clawbacks booked to the month of sale.

    Only rep-months that lose or gain a credit note are priced again, once as they are and once as they would be.
    """
    year = C.year_of("month_key").alias("year")
    paid = commission_rep_month(m).groupBy(year).agg(F.sum("commission").alias("paid"))
    changed = rep_month_base(m).join(moved_credit_notes(m), ["rep_key", "month_key"])
    versions = F.explode(F.array(F.lit(0), F.lit(1))).alias("_new")
    both = changed.select("*", versions).withColumns({
        "actual": (F.col("actual") + F.when(F.col("_new") == 1, F.col("net")).otherwise(F.lit(0))).cast(C.SUM_MONEY),
        "weighted_clawback": (F.col("weighted_clawback") + F.when(F.col("_new") == 1, F.col("weighted")).otherwise(F.lit(0))).cast(C.WEIGHTED)})
    priced = add_commission(both.drop("net", "weighted").withColumn("achievement", C.ratio("actual", "target")), m)
    difference = F.sum(F.when(F.col("_new") == 1, F.col("commission")).otherwise(-F.col("commission")))
    deltas = priced.groupBy(year).agg(difference.alias("_delta"))
    delta = F.coalesce("_delta", F.lit(0).cast("decimal(38,8)"))
    return paid.join(deltas, "year", "left").select("year", "paid", (F.col("paid") + delta).alias("moved"), (-delta).alias("leakage"))


def quarterly_pay(m: Model) -> DataFrame:
    """Rep-quarters priced on quarterly achievement with the plan in force in June of the year."""
    rep = kpi_rep_month(m).where(F.col("target").isNotNull())
    q = rep.groupBy("rep_key", "year", C.quarter_key("month_key").alias("quarter_key")).agg(
        F.sum("actual").alias("actual"), F.sum("target").alias("target"),
        F.sum("weighted_base").alias("weighted_base"), F.sum("commission").alias("commission_monthly"))
    june = m.plan_months.where(F.col("month_key") % 100 == 6).select(
        C.year_of("month_key").alias("year"), "plan_id", "cap_multiple_of_target")
    q = q.join(june, "year").withColumn("achievement", C.ratio("actual", "target"))
    cap = (F.col("cap_multiple_of_target") * F.col("target")).cast(C.WEIGHTED)
    base = capped_base(F.col("weighted_base").cast(C.WEIGHTED), cap)
    return band_join(q, m.tier_bands, "plan_id", "achievement").withColumn(
        "commission_quarterly", (base * F.col("commission_rate")).cast(C.PAY))


def scenario_table(m: Model) -> DataFrame:
    """Commission per year under monthly and under quarterly tiers."""
    q = quarterly_pay(m).groupBy("year").agg(F.sum("commission_monthly").alias("monthly"),
                                             F.sum("commission_quarterly").alias("quarterly"))
    rows = F.explode(F.array(
        F.struct(F.lit("Monthly tiers (actual plan)").alias("scenario"), F.col("monthly").alias("amount")),
        F.struct(F.lit("Quarterly tiers (what-if)").alias("scenario"), F.col("quarterly").alias("amount"))))
    return q.select("year", rows.alias("_s")).select("_s.scenario", "year", C.usd("_s.amount").alias("commission_usd"))


def scenario_summary(m: Model) -> DataFrame:
    """Leakage of the posting rule and effect of quarterly measurement, as one row."""
    moved = scenario_sale_month(m).agg(F.sum("paid").alias("paid"), F.sum("moved").alias("moved"))
    q = quarterly_pay(m)
    quarters = q.agg(F.sum("commission_quarterly").alias("quarterly"), F.sum("commission_monthly").alias("monthly"),
                     C.pct(C.count_if(F.col("commission_quarterly") > 0), F.count(F.lit(1))).alias("quarters_paid"))
    months = kpi_rep_month(m).where(F.col("target").isNotNull()).agg(
        C.pct(C.count_if(F.col("commission") > 0), F.count(F.lit(1)))).scalar()
    return one_row(moved, quarters).select(
        C.usd("paid").alias("baseline_commission_usd"), C.usd("moved").alias("clawback_to_sale_month_commission_usd"),
        C.usd(F.col("paid") - F.col("moved")).alias("clawback_leakage_usd"),
        C.pct(F.col("paid") - F.col("moved"), "paid", 2).alias("clawback_leakage_pct"),
        C.usd("quarterly").alias("quarterly_commission_usd"),
        F.round(100.0 * (C.ratio("quarterly", "monthly") - 1), 1).alias("quarterly_vs_monthly_pct"),
        months.alias("pct_rep_months_paid_monthly"), F.col("quarters_paid").alias("pct_rep_quarters_paid_quarterly"))


def concentration(m: Model, share: float = 0.2) -> DataFrame:
    """Share of commission and revenue of the best-paid fifth of the reps, and their correlation."""
    rep = kpi_rep_month(m)
    per_rep = rep.groupBy("rep_key").agg(F.sum("commission").alias("commission"), F.sum("actual").alias("revenue"))
    all_reps = per_rep.agg(F.sum("commission").alias("all_commission"), F.sum("revenue").alias("all_revenue"))
    top = top_rows(per_rep, "commission", "rep_key", share).agg(
        F.max("n_all").alias("reps"), F.sum("commission").alias("commission"), F.sum("revenue").alias("revenue"))
    together = rep.agg(F.round(F.corr(F.col("actual").cast("double"), F.col("commission").cast("double")), 3)).scalar()
    return one_row(top, all_reps).select(
        "reps", C.pct("commission", "all_commission").alias("top20pct_share_of_commission"),
        C.pct("revenue", "all_revenue").alias("top20pct_share_of_revenue"),
        together.alias("pearson_revenue_vs_commission_rep_month"))


def deal_volume(m: Model) -> DataFrame:
    """Deals per month against the department average, per settled rep of the later comparison year."""
    r = settled(kpi_rep_month(m)).where(F.col("year") == m.policy.compare_years[1])
    g = (r.groupBy("rep_key", "department_code")
         .agg(F.avg("deals").alias("deals"), F.sum("actual").alias("actual"), F.sum("target").alias("target"),
              F.count(F.lit(1)).alias("months")).where(F.col("months") >= m.policy.min_months))
    department = g.groupBy("department_code").agg(F.avg("deals").alias("_mean"))
    return g.join(department, "department_code").select(
        "rep_key", "department_code", "months", (100 * C.ratio("deals", "_mean")).alias("deal_index"),
        (100 * C.ratio("actual", "target")).alias("achievement_pct"))


def deal_volume_correlation(m: Model) -> DataFrame:
    return deal_volume(m).agg(F.count(F.lit(1)).alias("reps"),
                              F.round(F.corr("deal_index", "achievement_pct"), 4).alias("pearson_r"))


def headline(m: Model) -> DataFrame:
    """The figures quoted at the top of every report, as one row."""
    y0, y1 = m.policy.compare_years
    rep, team = kpi_rep_month(m), team_month(m)

    def of(column: str, year: int):
        return F.sum(F.when(F.col("year") == year, F.col(column)))

    last = rep.agg(F.max("month_key")).scalar()
    by_team = team.agg(*[of(c, y).alias(f"{n}_{y}") for c, n in (("actual", "revenue"), ("allocated_target", "target"))
                         for y in (y0, y1)])
    by_rep = rep.agg(*[of(c, y).alias(f"_{c}_{y}") for c in ("actual", "target", "commission") for y in (y0, y1)],
                     F.sum("gross_margin").alias("_gm"), F.sum("actual").alias("_all"),
                     C.count_if(F.col("month_key") == last).alias("active_reps_end"),
                     F.count_distinct("rep_key").alias("unique_reps"))
    odd = detect_anomalies(m).agg(F.count(F.lit(1)).alias("anomalies"),
                                  C.count_if(F.col("revenue_quality_flag") != "").alias("anomaly_spikes_month_end"))
    declining = detect_declines(m).agg(F.count(F.lit(1))).scalar()
    j = one_row(by_team, by_rep, odd)

    def growth(a: str, b: str):
        return F.round(100.0 * (C.ratio(a, b) - 1), 1)

    return j.select(
        *[C.usd(f"{n}_{y}").alias(f"{n}_{y}") for n in ("revenue", "target") for y in (y0, y1)],
        *[C.pct(f"revenue_{y}", f"target_{y}").alias(f"achievement_{y}_pct") for y in (y0, y1)],
        growth(f"revenue_{y1}", f"revenue_{y0}").alias("revenue_growth_pct"),
        growth(f"target_{y1}", f"target_{y0}").alias("target_growth_pct"),
        growth(f"_target_{y1}", f"_target_{y0}").alias("rep_target_growth_pct"),
        *[C.usd(f"_commission_{y}").alias(f"commission_{y}") for y in (y0, y1)],
        *[C.pct(f"_commission_{y}", f"_actual_{y}", 2).alias(f"commission_to_revenue_{y}_pct") for y in (y0, y1)],
        C.pct("_gm", "_all").alias("gross_margin_pct"), "active_reps_end", "unique_reps", "anomalies",
        "anomaly_spikes_month_end", declining.alias("declining_reps_trend"))


def company_rolling(m: Model) -> DataFrame:
    """Monthly and rolling three-month achievement of the company."""
    return company_month(team_month(m)).select(
        "month_key", (100 * F.col("achievement")).alias("achievement_pct"),
        (100 * F.col("rolling_3m_achievement")).alias("rolling_3m_achievement_pct"))

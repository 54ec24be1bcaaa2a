"""Metric layer: named measures that evaluate at any grain in one aggregate per fact.

A base measure is an aggregate of one fact; a derived measure is an expression over base
measures. Each fact is reduced to the grain before the results meet, so nothing fans out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attain.functions import columns as C
from attain.operators.joins import band_join, one_row
from attain.operators.ranking import group_rank
from attain.plans.commission import commission_rep_month, kpi_rep_month
from attain.plans.kpi import bounded_dense_rank, team_month
from attain.plans.model import Model, view


@dataclass(frozen=True)
class Base:
    """Aggregate of one fact."""

    fact: str
    aggregate: Callable[[], Column]


@dataclass(frozen=True)
class Derived:
    """Expression over other measures."""

    needs: tuple[str, ...]
    expression: Callable[[], Column]


def invoices() -> Column:
    return F.col("doc_type") == "INV"


def quotient(a: str, b: str) -> Derived:
    return Derived((a, b), lambda: C.ratio(a, b))


BASES: dict[str, Base] = {
    "net_revenue": Base("sales", lambda: C.total("net_amount_usd")),
    "invoiced_revenue": Base("sales", lambda: C.total("net_amount_usd", invoices())),
    "credit_notes": Base("sales", lambda: C.total("net_amount_usd", ~invoices())),
    "gross_list_value": Base("sales", lambda: C.total("gross_amount_usd", invoices())),
    "discount_amount": Base("sales", lambda: C.total("discount_amount_usd", invoices())),
    "gross_margin": Base("sales", lambda: C.total("gross_margin_usd")),
    "deals": Base("sales", lambda: F.count_distinct(F.when(invoices(), F.col("document_no")))),
    "strategic_revenue": Base("sales", lambda: C.total("strategic_amount_usd")),
    "month_end_revenue": Base("sales", lambda: C.total("month_end_amount_usd")),
    "target": Base("targets", lambda: F.sum("target_amount_usd")),
    "capacity_plan": Base("plan", lambda: F.sum("plan_amount_usd")),
    "commission": Base("rep_months", lambda: F.sum("commission")),
    "commissionable_base": Base("rep_months", lambda: F.sum("commissionable_base")),
    "rep_month_revenue": Base("rep_months", lambda: F.sum("actual")),
    "rep_months": Base("rep_months", lambda: F.count(F.lit(1))),
    "paid_rep_months": Base("rep_months", lambda: C.count_if(F.col("commission") > 0)),
    "capped_rep_months": Base("rep_months", lambda: C.count_if(F.col("is_capped") == 1)),
    "ramping_rep_months": Base("rep_months", lambda: C.count_if(F.col("is_ramp_month") == 1)),
    "accelerator_commission": Base("rep_months", lambda: F.sum(
        F.when(F.col("is_top_tier"), F.col("commission")).otherwise(F.lit(0).cast(C.PAY)))),
    "vacant_seat_months": Base("team_months", lambda: F.sum("vacant_seats")),
}

DERIVED: dict[str, Derived] = {
    "discount_rate_pct": quotient("discount_amount", "gross_list_value"),
    "credit_note_rate_pct": Derived(("credit_notes", "invoiced_revenue"),
                                    lambda: C.ratio(-F.col("credit_notes"), "invoiced_revenue")),
    "gross_margin_pct": quotient("gross_margin", "net_revenue"),
    "avg_deal_size": quotient("invoiced_revenue", "deals"),
    "strategic_mix_pct": quotient("strategic_revenue", "invoiced_revenue"),
    "month_end_share_pct": quotient("month_end_revenue", "invoiced_revenue"),
    "achievement_pct": quotient("net_revenue", "target"),
    "plan_achievement_pct": quotient("net_revenue", "capacity_plan"),
    "variance": Derived(("net_revenue", "target"), lambda: F.col("net_revenue") - F.col("target")),
    "capacity_gap": Derived(("capacity_plan", "target"), lambda: F.col("capacity_plan") - F.col("target")),
    "achievement_status": Derived(("net_revenue", "target"), lambda: F.when(F.col("target").isNull(), "No target")
                                  .when(achieved() >= 1.0, "On / above target")
                                  .when(achieved() >= 0.9, "Slightly below").otherwise("Materially below")),
    "achievement_color": Derived(("net_revenue", "target"), lambda: F.when(achieved() >= 1.0, "#0CA30C")
                                 .when(achieved() >= 0.9, "#FAB219").otherwise("#D03B3B")),
    "commission_to_revenue_pct": quotient("commission", "rep_month_revenue"),
    "reps_paid_pct": quotient("paid_rep_months", "rep_months"),
    "accelerator_share_pct": quotient("accelerator_commission", "commission"),
}


def achieved() -> Column:
    return C.ratio("net_revenue", "target")


@view(stage=["month_key"])
def sales_documents(m: Model) -> DataFrame:
    """Sales by team, rep, month and document: the grain on which documents can be counted at any coarser one."""
    sums = ("net_amount_usd", "gross_amount_usd", "discount_amount_usd", "gross_margin_usd")
    return m.fact_sales.groupBy("team_key", "rep_key", "month_key", "document_no", "doc_type").agg(
        *[C.total(c).alias(c) for c in sums],
        C.total("net_amount_usd", invoices() & (F.col("commission_weight") > 1)).alias("strategic_amount_usd"),
        C.total("net_amount_usd", invoices() & (F.col("is_month_end_window") == 1)).alias("month_end_amount_usd"))


def facts(m: Model, name: str) -> DataFrame:
    """A fact with the dimensions it can be grouped by."""
    teams = m.dim_team.select("team_key", "team_name", "country_code", "country_name", "department_code")
    teams = F.broadcast(teams)  # a list of teams, which does not grow with the facts
    year = C.year_of("month_key").alias("year")
    if name == "sales":
        df = sales_documents(m).join(teams, "team_key")
    elif name == "targets":
        df = m.fact_targets.join(teams, "team_key")
    elif name == "plan":
        df = m.fact_team_plan.join(teams, "team_key")
    elif name == "rep_months":
        top = m.tiers.groupBy("plan_id").agg(F.max_by("tier_name", "tier_order").alias("_top"))
        return (kpi_rep_month(m).join(m.dim_team.select("team_key", "country_name"), "team_key").join(top, "plan_id", "left")
                .withColumn("is_top_tier", F.coalesce(F.col("tier_name") == F.col("_top"), F.lit(False))).drop("_top"))
    else:
        return team_month(m).join(m.dim_team.select("team_key", "country_name"), "team_key")
    return df.select("*", year)


def bases_of(names: list[str]) -> list[str]:
    wanted = [n for name in names for n in (DERIVED[name].needs if name in DERIVED else (name,))]
    return list(dict.fromkeys(wanted))


def summed(rows: DataFrame, bases: list[str], by: list[str]) -> DataFrame:
    """Bases of one fact at a grain. Documents are counted apart from the sums: only their numbers are shuffled one by one,
    sums are combined before it. The two meet in an aggregate, which puts null groups together too."""
    apart = [[b for b in bases if b != "deals"], [b for b in bases if b == "deals"]]
    if not all(apart):
        return rows.groupBy(*by).agg(*[BASES[b].aggregate().alias(b) for b in bases])
    sums, deals = (rows.groupBy(*by).agg(*[BASES[b].aggregate().alias(b) for b in some]) for some in apart)
    return sums.unionByName(deals, allowMissingColumns=True).groupBy(*by).agg(*[F.max(b).alias(b) for b in bases])


def measure(m: Model, names: list[str], by: list[str], where: Callable[[], Column] | None = None) -> DataFrame:
    """Any measures at any grain: one aggregate per fact, joined on the grain, then the derived ones."""
    by_fact: dict[str, list[str]] = {}
    for base in bases_of(names):
        by_fact.setdefault(BASES[base].fact, []).append(base)
    parts = []
    for fact, bases in by_fact.items():
        rows = facts(m, fact)
        rows = rows.where(where()) if where else rows
        parts.append(summed(rows, bases, by) if by else rows.agg(*[BASES[b].aggregate().alias(b) for b in bases]))
    joined = reduce(lambda a, b: a.join(b, by, "full_outer"), parts) if by else one_row(*parts)
    return joined.select(*by, *[DERIVED[n].expression().alias(n) if n in DERIVED else F.col(n) for n in names])


# --------------------------------------------------------------------------- measures with their own shape
def time_measures(m: Model, by: list[str]) -> DataFrame:
    """Calendar shifts, year to date and rolling three months per calendar month within a grain.

    Frames run over the month index, so a month without sales is a gap and not the previous row.
    """
    base = measure(m, ["net_revenue", "target"], [*by, "month_key"]).withColumn(
        "_idx", C.month_index("month_key").cast("int")).withColumn("year", C.year_of("month_key"))
    spine = by or ["_all"]
    base = base if by else base.withColumn("_all", F.lit(0))
    by_index = W.partitionBy(*spine).orderBy("_idx")
    ytd = W.partitionBy(*spine, "year").orderBy("_idx").rangeBetween(W.unboundedPreceding, W.currentRow)
    last3 = by_index.rangeBetween(-2, 0)

    def shifted(months: int) -> Column:
        return F.max("net_revenue").over(by_index.rangeBetween(-months, -months))

    revenue = F.col("net_revenue")
    s = base.select("*", shifted(1).alias("net_revenue_pm"), shifted(12).alias("net_revenue_py"),
                    F.sum("net_revenue").over(ytd).alias("ytd_net_revenue"), F.sum("target").over(ytd).alias("ytd_target"),
                    F.sum("net_revenue").over(last3).alias("_r3"), F.sum("target").over(last3).alias("_t3"))
    return s.select(
        *by, "month_key", revenue.alias("mtd_net_revenue"), "net_revenue_pm",
        C.ratio(revenue - F.col("net_revenue_pm"), "net_revenue_pm").alias("mom_growth_pct"), "net_revenue_py",
        C.ratio(revenue - F.col("net_revenue_py"), "net_revenue_py").alias("yoy_growth_pct"), "ytd_net_revenue",
        "ytd_target", C.ratio("ytd_net_revenue", "ytd_target").alias("ytd_achievement_pct"),
        C.ratio("_r3", "_t3").alias("rolling_3m_achievement_pct"),
        (F.col("_r3").cast("double") / 3).alias("net_revenue_3m_avg"))


def commission_check(m: Model, by: list[str]) -> DataFrame:
    """Commission derived a second time from achievement, weighted base and cap; the difference must be 0."""
    rep = kpi_rep_month(m).where(F.col("target").isNotNull())
    bands = m.tier_bands.withColumnRenamed("commission_rate", "_rate").withColumnRenamed("tier_name", "_tier")
    again = band_join(rep, bands, "plan_id", "achievement")
    base = F.least(F.greatest(F.col("weighted_base"), F.lit(0).cast(C.WEIGHTED)), F.col("cap_amount"))
    check = again.groupBy(*by).agg(F.sum((base * F.col("_rate")).cast(C.PAY)).alias("commission_check"))
    paid = measure(m, ["commission"], by)
    return paid.join(check, by, "full_outer").withColumn(
        "check_difference", F.round(F.coalesce("commission", F.lit(0)) - F.coalesce("commission_check", F.lit(0)), 2))


GATES = tuple(Decimal(70 + i) / 100 for i in range(21))
ACCELERATORS = tuple(Decimal(10 + i) / 1000 for i in range(11))


def what_if_grid(m: Model, gates=GATES, accelerators=ACCELERATORS) -> DataFrame:
    """Commission for every gate and accelerator rate of the parameter grid.

    Pay is linear in the base above each edge, so one pass sums the base per edge and the grid is
    spread from that single row: the rep-months are never multiplied by the grid.
    """
    rep = commission_rep_month(m).where(F.col("target").isNotNull())
    ach, base = F.col("achievement"), F.col("commissionable_base")

    def held(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, base)), F.lit(0)).cast("decimal(34,4)")

    sums = rep.agg(F.array(*[held((ach >= float(g)) & (ach < 1.0)) for g in gates]).alias("low"),
                   held((ach >= 1.0) & (ach < 1.2)).alias("mid"), held(ach >= 1.2).alias("high"),
                   F.sum("commission").alias("paid"))
    gate_values = F.array(*[F.lit(float(g)) for g in gates])
    rates = F.array(*[F.lit(a).cast("decimal(5,4)") for a in accelerators])
    cells = (sums.select("*", F.posexplode(gate_values).alias("i", "gate_threshold"))
             .select("*", F.explode(rates).alias("accelerator_rate")))
    rate = [F.lit(Decimal(r)).cast("decimal(5,4)") for r in ("0.0050", "0.0100")]
    pay = (F.get("low", F.col("i")) * rate[0] + F.col("mid") * rate[1] + F.col("high") * F.col("accelerator_rate"))
    return cells.withColumn("pay", pay).select(
        "gate_threshold", F.col("accelerator_rate").cast("double").alias("accelerator_rate"),
        C.usd("pay", 2).alias("commission_what_if"), C.usd(F.col("pay") - F.col("paid"), 2).alias("what_if_vs_actual"))


def capacity_measures(m: Model, by: list[str]) -> DataFrame:
    """Period-end head counts (last month of the group), vacant seat-months and ramping rep-months."""
    rep, team = facts(m, "rep_months"), facts(m, "team_months")
    reps = rep.groupBy(*by, "month_key").agg(F.count(F.lit(1)).alias("_reps"))
    seats = team.groupBy(*by, "month_key").agg(F.sum("planned_headcount").alias("_seats"))
    ends = reps.join(seats, [*by, "month_key"], "full_outer").groupBy(*by).agg(
        F.max_by("_reps", "month_key").alias("active_reps_end"),
        F.max_by("_seats", "month_key").alias("planned_headcount_end"))
    return ends.join(measure(m, ["vacant_seat_months", "ramping_rep_months"], by), by)


def rep_ranks(m: Model, year: int) -> DataFrame:
    """Dense rank of every rep with a target by achievement, and deals against the department average."""
    rows = measure(m, ["net_revenue", "target", "deals"], ["rep_key"], lambda: F.col("year") == year)
    people = m.dim_employee.select(F.col("employee_key").alias("rep_key"), "employee_code", "full_name",
                                   "department_code")
    rows = rows.join(people, "rep_key")
    department = rows.where(F.col("deals") > 0).groupBy("department_code").agg(
        F.sum("deals").alias("_d"), F.count(F.lit(1)).alias("_n"))
    rows = rows.join(department, "department_code", "left").withColumns({
        "achievement_pct": F.when(F.col("target").isNotNull(), C.ratio("net_revenue", "target")),
        "deal_volume_index": 100 * C.ratio("deals", C.ratio("_d", "_n")),
        "rep_label": F.concat("full_name", F.lit(" ("), "employee_code", F.lit(")"))})
    return group_rank(rows, [], "achievement_pct", dense="salesperson_rank").drop("_d", "_n")


def place_ranks(m: Model, by: list[str], name: str) -> DataFrame:
    """Dense rank of teams or countries per year."""
    rows = measure(m, ["net_revenue", "target", "achievement_pct"], [*by, "year"])
    return bounded_dense_rank(rows, ["year"], "achievement_pct", name)


def narrative(m: Model) -> DataFrame:
    """Headline sentence and largest gap per year."""
    year = measure(m, ["net_revenue", "target", "achievement_pct"], ["year"])
    ordered = W.partitionBy(F.lit(0)).orderBy("year").rangeBetween(-1, -1)
    year = year.withColumn("_py", F.max("net_revenue").over(ordered))
    growth = F.round(100 * C.ratio(F.col("net_revenue") - F.col("_py"), "_py"), 1)
    signed = F.when(growth >= 0, F.concat(F.lit("+"), F.format_string("%.1f", growth))).otherwise(
        F.format_string("%.1f", growth))
    millions = F.format_number(F.round(F.col("net_revenue").cast("double") / 1e6, 1), 1)
    title = F.concat(F.lit("Net revenue $"), millions, F.lit("M | "),
                     F.format_string("%.1f", F.round(100 * F.col("achievement_pct"), 1)), F.lit("% of target | "),
                     F.when(growth.isNull(), "").otherwise(F.concat(signed, F.lit("%"))), F.lit(" YoY"))
    gaps = measure(m, ["variance"], ["year", "country_name"])
    worst = W.partitionBy("year").orderBy(F.asc_nulls_last("variance"))
    largest = (gaps.withColumn("_r", F.rank().over(worst)).where(F.col("_r") == 1).groupBy("year")
               .agg(F.array_join(F.array_sort(F.collect_list("country_name")), "").alias("largest_gap_country"),
                    F.min("variance").alias("_gap")))
    gap = F.round(F.col("_gap").cast("double") / 1e6, 1)
    money = F.concat(F.when(gap < 0, "-$").otherwise("$"), F.format_number(F.abs(gap), 1))
    return year.join(largest, "year").select(
        "year", title.alias("title_executive"), "largest_gap_country",
        F.concat(F.lit("Largest gap: "), "largest_gap_country", F.lit(" ("), money, F.lit("M vs target)"))
        .alias("insight_gap_text"))


def drill_down(m: Model) -> DataFrame:
    """Country, department and team totals in one matrix; levels are told apart by grouping id."""
    dims = ["country_name", "department_code", "team_name"]
    cells = measure(m, ["net_revenue", "target", "capacity_plan"], dims)
    g = cells.rollup(*dims).agg(F.sum("net_revenue").alias("net_revenue"), F.sum("target").alias("target"),
                                F.sum("capacity_plan").alias("capacity_plan"), F.grouping_id().alias("_g"))
    level = (F.when(F.col("_g") == 7, "total").when(F.col("_g") == 3, "country").when(F.col("_g") == 1, "department")
             .otherwise("team"))
    return g.select(level.alias("level"), *dims, "net_revenue", "target", "capacity_plan",
                    C.ratio("net_revenue", "target").alias("achievement_pct"),
                    (F.col("net_revenue") - F.col("target")).alias("variance"),
                    (F.col("capacity_plan") - F.col("target")).alias("capacity_gap"))


def month_matrix(m: Model) -> DataFrame:
    """Achievement of every country side by side per month."""
    names = [name for _, name, _, _ in m.policy.markets]
    rows = measure(m, ["achievement_pct"], ["month_key", "country_name"])
    label = F.date_format(F.make_date(C.year_of("month_key"), (F.col("month_key") % 100).cast("int"), F.lit(1)), "MMM yy")
    out = rows.groupBy("month_key").pivot("country_name", names).agg(F.max("achievement_pct"))
    return out.select("month_key", label.alias("month_label"),
                      *[F.col(f"`{n}`").alias(n.lower().replace(" ", "_")) for n in names])


def tier_mix(m: Model) -> DataFrame:
    """Tiers as percent of the plan's column total."""
    g = measure(m, ["rep_months"], ["plan_id", "tier_name"])
    return g.withColumn("pct_of_column",
                        C.pct("rep_months", F.sum("rep_months").over(W.partitionBy("plan_id")), 4))

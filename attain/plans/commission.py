"""Commission: plan in force, tier by achievement, weighted base, cap, payable amount."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attain.functions import columns as C
from attain.operators.joins import band_join
from attain.plans.kpi import add_names, rep_month_base, rep_month_trend
from attain.plans.model import Model, view
from attain.policy import NO_PLAN, NO_TARGET


def capped_base(weighted_base, cap):
    """Weighted base held between zero and the cap; zero without a target (a null cap)."""
    return F.when(cap.isNull(), F.lit(0)).otherwise(F.least(F.greatest(weighted_base, F.lit(0)), cap)).cast(C.WEIGHTED)


def add_commission(rep_months: DataFrame, m: Model) -> DataFrame:
    """Price rep-months carrying target, achievement and weighted inputs.

    Months that no plan covers stay, without a plan and without pay; uncovered_months lists them.
    """
    plans = m.plan_months.drop("clawback_window_days", "plan_name")
    base = rep_months.join(plans, "month_key", "left").withColumn(
        "weighted_base", (F.col("weighted_invoiced") + F.col("weighted_clawback")).cast(C.WEIGHTED)).withColumn(
        "cap_amount", (F.col("cap_multiple_of_target") * F.col("target")).cast(C.WEIGHTED))
    banded = band_join(base, m.tier_bands, "plan_id", "achievement")
    priced = (banded.withColumn("tier_name", F.when(F.col("plan_id").isNull(), NO_PLAN).otherwise(F.coalesce("tier_name", F.lit(NO_TARGET))))
              .withColumn("commission_rate", F.coalesce("commission_rate", F.lit(0).cast("decimal(5,4)")))
              .withColumn("commissionable_base", capped_base(F.col("weighted_base"), F.col("cap_amount"))))
    return priced.select(
        "*", (F.col("commissionable_base") * F.col("commission_rate")).cast(C.PAY).alias("commission"),
        F.coalesce((F.col("weighted_base") > F.col("cap_amount")).cast("int"), F.lit(0)).alias("is_capped"),
        C.achievement_band(F.col("achievement"), numbered=True).alias("achievement_band"),
    ).withColumn("effective_commission_rate", C.ratio("commission", "actual")).drop("cap_multiple_of_target")


@view
def commission_rep_month(m: Model) -> DataFrame:
    """Commission per active rep-month; invoices and pay inputs come from one pass over the facts."""
    base = rep_month_base(m).withColumn("achievement", C.ratio("actual", "target"))
    return add_commission(base, m)


@view(stage=["month_key"])
def kpi_rep_month(m: Model) -> DataFrame:
    """Rep-month KPIs with trend columns and commission."""
    return add_commission(add_names(rep_month_trend(m), m), m)


def uncovered_months(m: Model) -> DataFrame:
    """Active months no plan version covers: pay could not be computed for them."""
    return (m.bridge.groupBy("month_key").agg(F.count(F.lit(1)).alias("rep_months"))
            .join(m.plan_months.select("month_key"), "month_key", "left_anti"))


def plan_by_month(m: Model) -> DataFrame:
    """Plan version in force per active month with the rep-months it prices."""
    active = m.bridge.groupBy("month_key").agg(F.count(F.lit(1)).alias("rep_months"))
    return active.join(m.plan_months, "month_key", "left")

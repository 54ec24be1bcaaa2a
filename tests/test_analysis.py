"""Published figures, decompositions and scenario logic on small models."""

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from attain.plans import analysis, metrics
from attain.plans.commission import kpi_rep_month
from attain.plans.kpi import rep_month_performance, team_month
from attain.plans.sqlviews import reconcile_kpis
from frames import line, tiny_model

# Published company totals the decomposition has to reproduce.
YEARS = {2024: dict(rep_months=808, deals=6793, net=60_418_314.20),
         2025: dict(rep_months=907, deals=8061, net=68_229_114.72)}
HEADCOUNT_EFFECT, VOLUME_EFFECT = 7_425_415.806938454, 3_569_722.601190418


def test_lmdi_reproduces_published_effects(spark):
    rows = []
    for year, y in YEARS.items():
        for i in range(y["rep_months"]):
            first = i == 0
            rows.append((year, "EG", y["deals"] if first else 0, Decimal(str(y["net"])) * 2 if first else Decimal(0),
                         Decimal(str(y["net"])) if first else Decimal(0), Decimal(str(y["net"])) if first else Decimal(0)))
    rep = spark.createDataFrame(rows, "year int, country_code string, deals long, gross_list_value decimal(18,2), "
                                      "invoiced_revenue decimal(18,2), actual decimal(18,2)")
    out = {r["grain"]: r for r in analysis.lmdi_bridge(rep, (2024, 2025), ("country_code",)).collect()}
    for grain in ("company", "country_code"):
        r = out[grain]
        assert math.isclose(r["headcount_effect"], HEADCOUNT_EFFECT, rel_tol=1e-9)
        assert math.isclose(r["deal_volume_effect"], VOLUME_EFFECT, rel_tol=1e-9)
        assert abs(r["residual"]) < 1e-6
    assert (out["company"]["group"], out["country_code"]["group"]) == ("Company", "EG")


def test_lmdi_without_change_and_without_revenue(spark):
    schema = "year int, g string, deals long, gross_list_value decimal(18,2), invoiced_revenue decimal(18,2), actual decimal(18,2)"
    same = [(y, "same", 2, Decimal(100), Decimal(80), Decimal(70)) for y in (2024, 2025)]
    loss = [(2024, "loss", 2, Decimal(100), Decimal(80), Decimal(70)), (2025, "loss", 2, Decimal(100), Decimal(80), Decimal(-5))]
    out = {r["group"]: r for r in analysis.lmdi_bridge(spark.createDataFrame(same + loss, schema), (2024, 2025), ("g",)).collect()}
    assert out["same"]["headcount_effect"] == 0 and out["same"]["change"] == 0
    assert out["loss"]["credit_note_effect"] is None and out["loss"]["headcount_effect"] is None


def test_plan_bridge_adds_up_and_waterfall_ends_at_actual(spark):
    m = tiny_model(spark, [line(1, "INV", 90_000)], {(1, 202406): 100_000})
    bridge = analysis.plan_bridge(team_month(m))
    b = bridge.first()
    assert (b["plan"], b["vacancy_effect"], b["ramp_and_other_effect"], b["execution_effect"], b["actual"]) == (
        200_000, -100_000, 0, -10_000, 90_000)
    bars = analysis.waterfall(bridge).orderBy("step").collect()
    assert [(r["bar_base"], r["bar_height"]) for r in bars] == [
        (0, 200_000), (100_000, 100_000), (100_000, 0), (90_000, 10_000), (0, 90_000)]


def test_anomaly_needs_spread_and_distance(spark):
    months = [202401 + i for i in range(12)]
    lines = [line(i, "INV", 100_000 + i * 500 + (400_000 if mk == 202409 else 0), mk, end=1) for i, mk in enumerate(months)]
    flat = [line(100 + i, "INV", 100_000, mk, rep=2) for i, mk in enumerate(months)]
    m = tiny_model(spark, lines + flat, {(rep, mk): 100_000 for rep in (1, 2) for mk in months})
    rows = analysis.detect_anomalies(m).collect()
    assert [(r["employee_code"], r["month_key"], r["anomaly_type"]) for r in rows] == [("REP-1", 202409, "Spike")]
    assert rows[0]["revenue_quality_flag"] == "Spike concentrated in month-end window"


def test_decline_needs_slope_level_and_activity(spark):
    months = [202401 + i for i in range(9)]
    falling = [line(i, "INV", 150_000 - 12_000 * i, mk) for i, mk in enumerate(months)]
    steady = [line(100 + i, "INV", 100_000, mk, rep=2) for i, mk in enumerate(months)]
    m = tiny_model(spark, falling + steady, {(rep, mk): 100_000 for rep in (1, 2) for mk in months})
    rows = analysis.detect_declines(m).collect()
    assert [(r["employee_code"], r["slope_pp_per_month"], r["rolling_3m_latest_pct"]) for r in rows] == [("REP-1", -12.0, 66.0)]


def test_clawback_moves_to_the_month_of_sale(spark):
    lines = [line(1, "INV", 110_000, 202405, document="INV-A"), line(2, "INV", 120_000, 202406),
             line(3, "CN", -30_000, 202406, days=20, original="INV-A"),
             line(4, "CN", -1_000, 202406, days=200, original="INV-A"),
             line(5, "CN", -500, 202406, days=10, original="INV-GONE")]
    m = tiny_model(spark, lines, {(1, 202405): 100_000, (1, 202406): 100_000})
    row = analysis.scenario_sale_month(m).first()
    assert float(row["paid"]) == 110_000 * 0.01 + (120_000 - 30_000 - 500) * 0.005
    assert float(row["moved"]) == 80_000 * 0.005 + 120_000 * 0.010
    assert row["leakage"] == row["paid"] - row["moved"]


def test_quarterly_tiers(spark):
    lines = [line(1, "INV", 200_000, 202404), line(2, "INV", 50_000, 202405), line(3, "INV", 50_000, 202406)]
    m = tiny_model(spark, lines, {(1, mk): 100_000 for mk in (202404, 202405, 202406)})
    q = analysis.quarterly_pay(m).first()
    assert (q["quarter_key"], q["tier_name"], float(q["commission_monthly"]), float(q["commission_quarterly"])) == (
        20242, "T2 On Target", 150_000 * 0.015, 300_000 * 0.01)


def test_performance_view_trends_and_ranks(spark):
    lines = [line(1, "INV", 50_000, 202411), line(2, "INV", 100_000, 202412), line(3, "INV", 150_000, 202501),
             line(4, "INV", 100_000, 202412, rep=2)]
    targets = {(1, mk): 100_000 for mk in (202411, 202412, 202501)} | {(2, 202412): 100_000, (2, 202501): None}
    rows = {(r["rep_key"], r["month_key"]): r for r in rep_month_performance(tiny_model(spark, lines, targets)).collect()}
    assert rows[(1, 202412)]["mom_growth"] == 1.0 and rows[(1, 202411)]["mom_growth"] is None
    assert rows[(1, 202412)]["ytd_actual"] == 150_000 and rows[(1, 202501)]["ytd_actual"] == 150_000
    assert rows[(1, 202501)]["rolling_3m_achievement"] == 1.0
    assert [rows[(k, 202412)]["rank_in_team"] for k in (1, 2)] == [1, 1]
    assert rows[(2, 202501)]["rank_in_company"] is None and rows[(2, 202501)]["performance_band"] == "No Target"


def test_measures_agree_between_grains(spark):
    lines = [line(i, "INV" if i % 3 else "CN", (1 if i % 3 else -0.2) * 1000 * i, 202401 + i % 12, rep=1 + i % 2, days=5)
             for i in range(1, 40)]
    m = tiny_model(spark, lines, {(rep, 202401 + i): 5000 for rep in (1, 2) for i in range(12)})
    names = ["net_revenue", "invoiced_revenue", "credit_notes", "target", "rep_months", "commission"]
    whole = metrics.measure(m, names, []).first()
    by_rep = metrics.measure(m, names, ["rep_key"]).agg(*[F.sum(n).alias(n) for n in names]).first()
    assert whole.asDict() == by_rep.asDict()
    check = metrics.commission_check(m, ["year"]).first()
    assert check["check_difference"] == 0 and check["commission"] == kpi_rep_month(m).agg(F.sum("commission")).first()[0]


def test_what_if_grid_reprices_one_gate(spark):
    m = tiny_model(spark, [line(1, "INV", 82_000), line(2, "INV", 130_000, rep=2)], {(1, 202406): 100_000, (2, 202406): 100_000})
    grid = {(round(r["gate_threshold"], 2), round(r["accelerator_rate"], 3)): r["commission_what_if"]
            for r in metrics.what_if_grid(m).collect()}
    assert len(grid) == 231
    assert grid[(0.80, 0.015)] == pytest.approx(82_000 * 0.005 + 130_000 * 0.015)
    assert grid[(0.85, 0.020)] == pytest.approx(130_000 * 0.020)


def test_calendar_measures_skip_gaps(spark):
    m = tiny_model(spark, [line(1, "INV", 100, 202401), line(2, "INV", 300, 202403)], {(1, 202401): 100})
    rows = {r["month_key"]: r for r in metrics.time_measures(m, []).collect()}
    assert rows[202403]["net_revenue_pm"] is None and rows[202403]["ytd_net_revenue"] == 400
    assert rows[202403]["net_revenue_3m_avg"] == pytest.approx(400 / 3)


def test_two_implementations_reconcile(spark):
    lines = [line(i, "INV" if i % 4 else "CN", (1 if i % 4 else -0.3) * 900 * i, 202401 + i % 12, rep=1 + i % 3, days=i * 5,
                  weight="1.25" if i % 5 == 0 else "1.00") for i in range(1, 90)]
    targets = {(rep, 202401 + i): None if (rep + i) % 7 == 0 else 4000 * rep for rep in (1, 2, 3) for i in range(12)}
    assert all(r["passed"] for r in reconcile_kpis(tiny_model(spark, lines, targets)).collect())


def rerun_of_sale_months(m):
    """The scenario by its definition: credit notes inside the window carry the month of their invoice, and all is priced again."""
    from attain.functions import columns as C
    from attain.plans.commission import commission_rep_month

    inv = F.col("doc_type") == "INV"
    booked = m.fact_sales.where(inv).groupBy(F.col("document_no").alias("original_document_no")).agg(F.min("month_key").alias("_sale"))
    notes = (m.fact_sales.where(~inv).join(m.plan_months.select("month_key", "clawback_window_days"), "month_key", "left")
             .join(booked, "original_document_no", "left"))
    month = F.when(F.col("days_since_original") <= F.col("clawback_window_days"), F.col("_sale")).otherwise(F.col("month_key"))
    restated = m.fact_sales.where(inv).unionByName(notes.withColumn("month_key", month).select(*m.fact_sales.columns))
    year = C.year_of("month_key").alias("year")
    return {r["year"]: r["moved"] for r in commission_rep_month(m.with_(fact_sales=restated)).groupBy(year).agg(F.sum("commission").alias("moved")).collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sale_month_deltas_equal_the_full_rerun(spark, seed):
    import random

    r = random.Random(seed)
    months = [y * 100 + k for y in (2024, 2025) for k in range(1, 13)]
    lines, documents = [], []
    for i in range(400):
        if i < 20 or r.random() < 0.6:
            month = r.choice(months)
            documents.append((f"D{r.randrange(150)}", month))
            lines.append(line(i, "INV", r.uniform(1, 60_000), month, r.randint(1, 4), r.choice(["1.00", "1.50"]), document=documents[-1][0]))
        else:
            original = r.choice([d for d, _ in documents] + ["gone", None])
            lines.append(line(i, "CN", -r.uniform(1, 30_000), r.choice(months), r.randint(1, 5), r.choice(["1.00", "1.50"]),
                              days=r.choice([None, 0, 30, 89, 90, 91, 400]), original=original))
    targets = {(rep, month): r.choice([20_000, 60_000, 150_000, None]) for rep in range(1, 4) for month in months if r.random() < 0.9}
    m = tiny_model(spark, lines, targets)
    got = analysis.scenario_sale_month(m).collect()
    again = rerun_of_sale_months(m)
    assert {x["year"]: x["moved"] for x in got} == again and any(x["leakage"] for x in got)
    assert all(x["paid"] - x["moved"] == x["leakage"] for x in got)


def test_sale_month_without_credit_notes(spark):
    m = tiny_model(spark, [line(1, "INV", 90_000)], {(1, 202406): 80_000})
    row = analysis.scenario_sale_month(m).first()
    assert row["paid"] == row["moved"] > 0 and row["leakage"] == 0

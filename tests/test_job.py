"""The whole chain from CSV extracts to written tables, and every gate that stops it."""

import csv

import pytest
from pyspark.sql import functions as F

from attain.operators import checks
from attain.plans import job
from attain.plans.etl import Extracts, Run
from attain.policy import Policy
from test_etl import LINES, sale, write_folder

GOOD = [x for x in LINES if x["line_id"] not in ("L022",)]


def fill(folder, lines):
    """Extracts that pass every gate: without the targets of a rep who had not joined or had left."""
    write_folder(folder / "raw", lines)
    rewrite(folder, "sales_targets", lambda r: None if r["rep_code"] == "REP-002" and r["target_month"][5:] in ("01", "10", "11", "12") else r)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "raw").mkdir()
    fill(tmp_path, GOOD)
    return tmp_path


def rewrite(folder, name, change):
    path = folder / "raw" / f"raw_{name}.csv"
    with open(path, newline="") as f:
        rows = list(csv.DictReader(f))
    changed = [r for r in map(change, rows) if r]
    with open(path, "w", newline="") as f:
        w = csv.DictWriter(f, rows[0].keys())
        w.writeheader()
        w.writerows(changed)


def run(spark, folder):
    return job.run_job(spark, str(folder / "raw"), str(folder / "out"), Policy())


def test_from_csv_to_written_tables(spark, folder):
    names = run(spark, folder)
    assert len(names) == len(set(names))
    for name in names:
        kind = spark.read.json if name == "headline" else spark.read.parquet
        assert kind(f"{folder}/out/{name}").columns
    fact, team = spark.read.parquet(f"{folder}/out/fact_sales"), spark.read.parquet(f"{folder}/out/kpi_team_month")
    assert fact.agg(F.sum("net_amount_usd")).first()[0] == team.agg(F.sum("actual")).first()[0]
    assert spark.read.json(f"{folder}/out/headline").count() == 1


def test_rows_must_balance(spark, folder, monkeypatch):
    monkeypatch.setattr(Run, "repeats", property(lambda self: self.x.spark.sql("SELECT 5L AS dropped_duplicates, 9L AS _total")))
    with pytest.raises(ValueError, match="reconciliation"):
        run(spark, folder)
    assert not (folder / "out").exists()


def test_a_repeated_master_code_stops_the_run(spark, folder):
    rewrite(folder, "customers", lambda r: r)
    with open(folder / "raw" / "raw_customers.csv", "a") as f:
        f.write("C1,Customer Two,AE,SMB,Retail,Dubai,T1,2020-01-01\r\n")
    with pytest.raises(ValueError, match="declared constraints"):
        run(spark, folder)


def test_integrity_checks_stop_the_run(spark, folder):
    fill(folder, GOOD + [sale(40, quantity="many")])
    with pytest.raises(ValueError, match="IC-07"):
        run(spark, folder)


def test_assertions_stop_the_run(spark, folder):
    rewrite(folder, "team_plan", lambda r: {**r, "plan_amount_usd": "100"})
    with pytest.raises(ValueError, match="A09"):
        run(spark, folder)


def test_uncovered_months_stop_the_run(spark, folder):
    rewrite(folder, "commission_plans", lambda r: r if r["plan_id"] == "CP2024" else None)
    with pytest.raises(ValueError, match="202501"):
        run(spark, folder)


def test_differing_kpis_stop_the_run(spark, folder, monkeypatch):
    monkeypatch.setattr(job, "reconcile_kpis", lambda m: checks.reconcile(
        m.bridge, m.bridge.withColumn("tenure_months", F.lit(-7)), ["rep_key", "month_key"], {"tenure_months": 0.0}))
    with pytest.raises(ValueError, match="KPI reconciliation"):
        run(spark, folder)
    assert not (folder / "out" / "kpi_rep_month").exists()


def test_residuals_stop_the_run(spark):
    with pytest.raises(ValueError, match="residual"):
        job.require_explained({"bridge": spark.sql("SELECT 1.0D AS residual")})
    job.require_explained({"bridge": spark.sql("SELECT 0.001D AS residual")})


def test_rates_of_the_plan_extract_decide_the_pay(spark, folder):
    from attain.plans.commission import kpi_rep_month

    def paid():
        m = Run(Extracts.from_csv(spark, str(folder / "raw"), Policy()), staged=True).model
        return kpi_rep_month(m).agg(F.sum("commission")).first()[0]

    assert paid() == 0  # nobody reaches the gate
    rewrite(folder, "commission_plans", lambda r: {**r, "commission_rate": "0.0200"} if r["tier_order"] == "1" else r)
    assert paid() > 0


@pytest.mark.parametrize("change, rule", [({"discount_pct": "150"}, "DQ-S14"), ({"discount_pct": "1e30"}, "DQ-S14"),
                                          ({"quantity": "1e20"}, "DQ-S10"), ({"net_amount_local": "NaN"}, "DQ-S10")])
def test_numbers_that_do_not_fit_are_held_back(spark, folder, change, rule):
    write_folder(folder / "raw", [sale(1), sale(2, **change)])
    held = Run(Extracts.from_csv(spark, str(folder / "raw"), Policy())).quarantine.collect()
    assert [(r["line_id"], r["dq_failed_rules"]) for r in held] == [("L002", rule)]


def test_wide_numbers_are_kept_exactly(spark, folder):
    write_folder(folder / "raw", [sale(1, quantity="123456789"), sale(2, net_amount_local="661.055")])
    rows = {r["line_id"]: r for r in Run(Extracts.from_csv(spark, str(folder / "raw"), Policy())).clean.collect()}
    assert rows["L001"]["quantity"] == 123456789 and str(rows["L002"]["net_amount_local"]) == "661.0550"

"""CSV extracts to star schema on hand-built and on randomly damaged ledgers."""

import csv
import re
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from attain.operators import checks
from attain.plans.commission import kpi_rep_month
from attain.plans.etl import Extracts, Run, process_sales, require_balanced
from attain.plans.kpi import country_month, team_month
from attain.plans.questions import QUESTIONS
from attain.policy import Policy
from attain.schema import RAW, model_columns
from attain.sources import io

def sale(i, **changes):
    row = dict(line_id=f"L{i:03d}", document_no=f"INV-{i}", doc_type="INV", original_document_no="",
               document_date="2024-03-10", rep_code="REP-001", customer_code="C1", country="UAE", sku="SEC-1",
               quantity="2", unit_list_price_local="367.25", discount_pct="0.10", net_amount_local="661.05",
               currency="AED", exported_at="2024-04-01")
    return {**row, **changes}


def credit(i, of, **changes):
    base = dict(document_no=f"CN-{i}", doc_type="CN", original_document_no=of, quantity="-1",
                net_amount_local="-330.53", document_date="2024-04-20")
    return sale(i, **{**base, **changes})


LINES = [
    sale(1), sale(1),                                                     # exported twice
    sale(2, document_date="11/03/2024", country=" u.a.e. ", sku=" sec-1"),  # three corrections
    sale(3, document_date="soon"), sale(4, document_date="2026-01-01"), sale(5, rep_code=""),
    sale(6, rep_code="REP-999"), sale(7, sku="NOPE"), sale(8, customer_code="C9"), sale(9, currency="XXX"),
    sale(10, country="Mars"), sale(11, quantity="-2"), sale(12, discount_pct="0.75"),
    sale(13, unit_list_price_local="0", net_amount_local="0"),            # repaired
    sale(14, net_amount_local="700"),                                     # flagged only
    sale(15, document_date="2024-01-31", rep_code="REP-002"),             # before the rep joined a team
    credit(16, "INV-1"), credit(17, "INV-404"), credit(18, ""), credit(19, "INV-2", quantity="1"),
    sale(20, document_date="2024-06-20"),                                 # after the move to another team
    credit(21, "INV-20", document_date="2024-07-01", net_amount_local="-900"),
    sale(22, quantity="many"), sale(23, customer_code="C9", currency=""),
]


def write_folder(folder, lines):
    def table(name, rows):
        columns = re.findall(r"(\w+) (?:string|int|date|double|decimal)", RAW[name])
        with open(folder / f"raw_{name}.csv", "w", newline="") as f:
            w = csv.DictWriter(f, columns)
            w.writeheader()
            w.writerows({k: v for k, v in zip(columns, r)} if isinstance(r, tuple) else r for r in rows)

    months = [f"2024-{m:02d}" for m in range(1, 13)]
    table("sales_lines", lines)
    table("sales_targets", [(m, r, 1000, 1, "2024-01-01") for m in months for r in ("REP-001", "REP-002")]
          + [("2024-05", "REP-001", 1200, 2, "2024-05-01"), ("2024-06", "REP-002", -5, 2, "2024-06-01"),
             ("2024-06", "REP-404", 10, 1, "2024-06-01")])
    table("team_plan", [("T1", m, 2, 3000) for m in months] + [("T2", m, 1, 1500) for m in months])
    table("employees", [("MGR-01", "Mona", "Sales Manager", "2019-01-01", "", "AE", "T1"),
                        ("MGR-02", "Nour", "Sales Manager", "2019-01-01", "", "AE", "T2"),
                        ("REP-001", "Rami", "Sales Representative", "2022-01-15", "", "", ""),
                        ("REP-002", "Sara", "Sales Representative", "2024-02-10", "2024-09-20", "", "")])
    table("rep_assignments", [("REP-001", "T1", "2022-01-15", "2024-05-31"), ("REP-001", "T2", "2024-06-01", ""),
                              ("REP-002", "T1", "2024-02-10", "2024-09-20")])
    table("teams", [("T1", "UAE Enterprise", "AE", "ENT", 2, 2, "MGR-01"), ("T2", "UAE SME", "AE", "SME", 1, 1, "MGR-02")])
    table("customers", [("C1", "Customer One", "AE", "SMB", "Retail", "Dubai", "T1", "2020-01-01")])
    table("products", [("SEC-1", "Firewall", "Cybersecurity", 100, 0.55), ("NET-1", "Line", "Connectivity", 50, 0.5)])
    table("fx_rates", [(f"2024-{m:02d}", c, r) for m in range(1, 13) for c, r in (("AED", 3.6725), ("USD", 1))])
    rows = []
    for p in Policy().plans:
        for i, t in enumerate(p.tiers, start=1):
            rows.append((p.plan_id, p.name, p.effective_from, p.effective_to, i, t.name, t.floor, t.ceiling, t.rate,
                         p.strategic_weight, p.cap_multiple, p.clawback_days))
    table("commission_plans", rows)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    write_folder(folder, LINES)
    return Run(Extracts.from_csv(spark, str(folder), Policy()), staged=True)


def test_missing_extract_names_the_step(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="extract"):
        io.read_raw(spark, str(tmp_path))


def test_rule_log(run):
    log = {r["rule_id"]: r["rows_affected"] for r in run.rule_log.collect()}
    assert {k: v for k, v in log.items() if v} == {
        "STD-01": 1, "STD-02": 1, "STD-03": 1, "DQ-S01": 1, "DQ-S02": 1, "DQ-S03": 1, "DQ-S04": 1, "DQ-S05": 1,
        "DQ-S06": 1, "DQ-S07": 2, "DQ-S08": 2, "DQ-S09": 1, "DQ-S10": 1, "DQ-S11": 1, "DQ-S12": 1, "DQ-S13": 1,
        "DQ-S14": 1, "DQ-S15": 5, "DQ-S16": 1, "DQ-S17": 1, "DQ-S18": 1, "DQ-T01": 2, "DQ-T02": 1, "DQ-T03": 1,
        "DQ-T04": log["DQ-T04"]}
    assert len(log) == 25


def test_quarantine_lists_every_row_rule_but_one_late_rule(run):
    held = {r["line_id"]: r["dq_failed_rules"] for r in run.quarantine.collect()}
    assert held["L023"] == "DQ-S07;DQ-S08" and held["L015"] == "DQ-S16"
    assert held["L017"] == "DQ-S17" and held["L021"] == "DQ-S18"
    assert not {"L001", "L002", "L013", "L014", "L016", "L020", "L022"} & held.keys()


def test_reconciliation_balances(run):
    row = run.reconciliation.first()
    assert (row["raw_rows"], row["dropped_duplicates"], row["balanced"]) == (len(LINES), 1, True)
    require_balanced(run.reconciliation)


def test_repaired_and_converted_amounts(run):
    rows = {r["line_id"]: r for r in run.fact_sales.collect()}
    fixed = rows["L013"]
    assert (fixed["gross_amount_usd"], fixed["net_amount_usd"]) == (Decimal("200.00"), Decimal("180.00"))
    assert (rows["L001"]["net_amount_usd"], rows["L001"]["cost_amount_usd"]) == (Decimal("180.00"), Decimal("110.00"))
    assert rows["L001"]["commission_weight"] == Decimal("1.25")
    assert rows["L022"]["quantity"] is None and rows["L022"]["gross_amount_usd"] is None


def test_credit_note_inherits_team_of_its_invoice(run):
    rows = {r["line_id"]: r for r in run.fact_sales.collect()}
    assert rows["L016"]["team_key"] == rows["L001"]["team_key"] == 1
    assert rows["L016"]["days_since_original"] == 41
    assert rows["L020"]["team_key"] == 2


def test_bridge_and_targets(run):
    bridge = {(r["rep_key"], r["month_key"]): r for r in run.bridge.where("month_key < 202501").collect()}
    assert bridge[(3, 202405)]["team_key"] == 1 and bridge[(3, 202406)]["team_key"] == 2
    assert (4, 202401) not in bridge and bridge[(4, 202402)]["is_ramp_month"] == 1       # hired on the 10th
    assert (4, 202409) in bridge and (4, 202410) not in bridge                           # left on the 20th
    assert bridge[(4, 202405)]["is_ramp_month"] == 0 and bridge[(4, 202405)]["tenure_months"] == 3
    targets = {(r["rep_key"], r["month_key"]): r["target_amount_usd"] for r in run.fact_targets.collect()}
    assert targets[(3, 202405)] == 1200 and (4, 202406) not in targets


def test_dimensions(run):
    people = {r["employee_code"]: r for r in run.dim_employee.collect()}
    assert people["MGR-01"]["manager_code"] is None and people["MGR-01"]["current_team_id"] == "T1"
    assert people["REP-001"]["current_team_id"] == "T2" and people["REP-001"]["manager_code"] == "MGR-02"
    assert people["REP-002"]["employment_status"] == "Exited" and people["REP-002"]["tenure_band"] == "6-12m"
    assert people["REP-002"]["is_new_hire_in_period"] == 1
    assert [r["employee_key"] for r in run.dim_employee.orderBy("employee_code").collect()] == [1, 2, 3, 4]
    assert {r["sku"]: r["is_strategic"] for r in run.dim_product.collect()} == {"SEC-1": 1, "NET-1": 0}
    for name in ("dim_team", "dim_employee", "dim_product", "dim_customer", "fact_sales"):
        assert getattr(run, name).columns == model_columns(name)


def test_checks_on_the_model(run):
    got = {r["check_id"]: r["failing_rows"] for r in checks.integrity_checks(run.model).collect()}
    assert got == {**{f"IC-{i:02d}": 0 for i in range(1, 12)}, "IC-07": 1}      # the line without a quantity
    with pytest.raises(ValueError, match="IC-07"):
        checks.require_passed(checks.integrity_checks(run.model), "integrity")
    violated = checks.constraint_violations(run.model).where("not passed").collect()
    assert [r["description"] for r in violated] == []


def test_every_question_runs_on_the_csv_model(run):
    for name, question in QUESTIONS.items():
        question(run.model).collect()


def test_revenue_ties_to_teams(run):
    fact = run.fact_sales.agg({"net_amount_usd": "sum"}).first()[0]
    assert team_month(run.model).agg({"actual": "sum"}).first()[0] == fact


def test_tables_are_written_and_read_back(spark, run, tmp_path):
    io.write_model({"fact_sales": run.fact_sales, "bridge": run.bridge}, str(tmp_path))
    io.write_kpis({"kpi_rep_month": kpi_rep_month(run.model), "kpi_country_month": country_month(team_month(run.model))},
                  str(tmp_path))
    fact = spark.read.parquet(f"{tmp_path}/fact_sales")
    assert fact.count() == run.fact_sales.count() and (tmp_path / "fact_sales" / "month_key=202403").exists()
    pruned = fact.where("month_key = 202403")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_key" in pruned
    assert spark.read.parquet(f"{tmp_path}/kpi_rep_month").where("date_key <> month_key * 100 + 1").count() == 0
    io.write_record(spark.range(1), f"{tmp_path}/record")
    with pytest.raises(ValueError, match="nope"):
        io.project(run.bridge, ["rep_key", "nope"], "bridge")


FAULTS = [{}, {"document_date": "x"}, {"document_date": "05/03/2024"}, {"rep_code": "REP-9"}, {"sku": "sec-1 "},
          {"currency": "EUR"}, {"quantity": "-3"}, {"net_amount_local": "0"}, {"discount_pct": "0.9"}, {"country": ""}]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 8), st.sampled_from(FAULTS), st.booleans()), min_size=1, max_size=25))
def test_no_row_is_lost_or_invented(spark, run, tmp_path_factory, picks):
    folder = tmp_path_factory.mktemp("faulty")
    lines = [{**(credit(i, f"INV-{(i % 4) + 1}") if is_credit else sale(i)), **fault} for i, fault, is_credit in picks]
    write_folder(folder, lines)
    clean, quarantine, _, reconciliation = process_sales(Extracts.from_csv(spark, str(folder), Policy()))
    row = reconciliation.first()
    assert row["balanced"] and row["raw_rows"] == len(lines)
    kept = [r["line_id"] for r in clean.select("line_id").collect()] + [
        r["line_id"] for r in quarantine.select("line_id").collect()]
    assert sorted(kept) == sorted({x["line_id"] for x in lines})


def test_a_repair_that_does_not_fit_holds_the_line_back(spark, tmp_path):
    zero = dict(unit_list_price_local="0", net_amount_local="0")
    write_folder(tmp_path, [
        sale(1), sale(2, quantity="123456789", discount_pct="-9000", **zero),   # beyond 16 digits, held back by its discount
        sale(3, quantity="9000000000", **zero),                                # beyond 16 digits, fits the repaired column
        sale(4, quantity="-9000000000", discount_pct="-9000", **zero)])         # fits no column
    run = Run(Extracts.from_csv(spark, str(tmp_path), Policy()), staged=True)
    held = {r["line_id"]: r for r in run.quarantine.collect()}
    assert {k: r["dq_failed_rules"] for k, r in held.items()} == {"L002": "DQ-S14", "L004": "DQ-S10;DQ-S14"}
    assert held["L004"]["net_amount_local"] == 0
    net = {r["line_id"]: r["net_amount_usd"] for r in run.fact_sales.collect()}
    assert net == {"L001": Decimal("180.00"), "L003": Decimal("810000000000.00")}


def test_an_unfit_repair_alone_is_an_impossible_amount(spark, tmp_path):
    write_folder(tmp_path, [sale(1), sale(2, sku="GOLD", quantity="9999999999", unit_list_price_local="0")])
    with open(tmp_path / "raw_products.csv", "a") as f:
        f.write("GOLD,Gold,Connectivity,99999999,0.5\n")
    run = Run(Extracts.from_csv(spark, str(tmp_path), Policy()), staged=True)
    assert [(r["line_id"], r["dq_failed_rules"]) for r in run.quarantine.collect()] == [("L002", "DQ-S10")]
    log = {r["rule_id"]: r["rows_affected"] for r in run.rule_log.collect()}
    assert (log["DQ-S10"], log["DQ-S13"]) == (1, 1)
    require_balanced(run.reconciliation)
    assert [r["line_id"] for r in run.fact_sales.collect()] == ["L001"]


def test_repeats_go_before_the_masters_are_met(spark, run, tmp_path):
    """Only the lines that stay are written, without the raw text of repeats, and customers are met by clean lines only."""
    assert not run.codes_repeat and "all_lines" not in run.__dict__
    assert {r["line_id"] for r in run.kept.collect()} == {x["line_id"] for x in LINES} and "raw" not in run.kept.columns
    assert [r["customer_code"] for r in run.strangers["customer_code"].collect()] == ["C9"]
    assert [r["sku"] for r in run.strangers["sku"].collect()] == ["NOPE"] and "product_key" not in run.kept.columns
    assert {r["customer_key"] for r in run.fact_sales.collect()} == {1}
    staged = {re.sub("-[0-9a-f]{32}$", "", p.name): p for p in __import__("pathlib").Path(run.folder.removeprefix("file:")).iterdir()}
    assert not {"checked_lines", "routed_lines"} & staged.keys()
    assert [r["line_id"] for r in spark.read.parquet(str(staged["repaired_lines"])).collect()] == ["L013"]
    written = spark.read.parquet(str(staged["routed_notes"]))
    assert {r["doc_type"] for r in written.select("doc_type").distinct().collect()} == {"CN"}


def test_masters_with_a_code_twice_multiply_lines_and_counts(spark, tmp_path):
    write_folder(tmp_path, [sale(1), sale(1), sale(2), sale(3, customer_code="C9"), sale(4, customer_code=None)])
    with open(tmp_path / "raw_customers.csv", "a") as f:
        f.write("C1,Again,AE,SMB,Retail,Dubai,T1,2020-01-01\n")
    twice = Run(Extracts.from_csv(spark, str(tmp_path), Policy()), staged=True)
    assert twice.codes_repeat
    assert sorted(r["line_id"] for r in twice.clean.collect()) == ["L001", "L002", "L002"]
    log = {r["rule_id"]: r["rows_affected"] for r in twice.rule_log.collect()}
    assert (log["DQ-S01"], log["DQ-S07"]) == (3, 2)


def test_stage_tables_give_back_what_they_have_shuffled(spark, tmp_path):
    import glob
    import time

    from attain.sources.stage import store

    folder = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()[0]
    shuffled = lambda: set(glob.glob(f"{folder}/**/shuffle_*.data", recursive=True))
    before = shuffled()
    out = store(spark.range(20_000).repartition(7, "id").groupBy((F.col("id") % 999).alias("k")).agg(F.count(F.lit(1)).alias("n")), "given_back", folder=str(tmp_path))
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before and out.count() == 999

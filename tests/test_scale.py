"""Plans and steps whose cost must not grow faster than the input."""

from decimal import Decimal

from pyspark.sql import functions as F

from attain import catalog
from attain.plans import kpi, metrics
from frames import line, tiny_model

FOLDER = "/root/testdata/sf0.001"


def tasks(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rep_months_are_spread_over_tasks(spark):
    m = catalog.model(spark, FOLDER)
    assert tasks(m.assignments) == 1 and tasks(m.bridge) > 1 and tasks(m.raw_targets) > 1


def test_raw_lines_are_written_for_queries_that_read_them_only(spark, tmp_path):
    from fixtures.extracts import ledger_extracts
    from attain.plans.etl import Run
    from attain.sources.ledger import LedgerModel

    run = Run(ledger_extracts(LedgerModel(spark, FOLDER)), staged=True)
    assert run.tiers.count() == 8 and run.checked_targets.count() > 0
    assert "sales_lines" not in run.x.__dict__
    assert run.x.sales_lines.count() > 0 and run.x.sales_lines is run.x.sales_lines


def test_lines_are_shuffled_once_for_sums_and_documents(spark):
    m = tiny_model(spark, [line(1, "INV", 100, document="A"), line(2, "INV", 50, document="A"), line(3, "INV", 7, rep=2, document="A"),
                           line(4, "CN", -20, days=10, document="B"), line(5, "INV", 1, month=202407, document="C")],
                   {(1, 202406): 100, (2, 202406): 100, (1, 202407): 100})
    sales = kpi.rep_month_sales(m)
    assert plan(sales).count("Exchange hashpartitioning(rep_key") == 1
    got = {(r["rep_key"], r["month_key"]): (r["actual"], r["deals"]) for r in sales.collect()}
    assert got == {(1, 202406): (Decimal("130.00"), 1), (2, 202406): (Decimal("7.00"), 1), (1, 202407): (Decimal("1.00"), 1)}


def test_documents_are_counted_apart_from_sums_also_where_the_group_is_null(spark):
    rows = spark.createDataFrame([("x", "A", "INV", Decimal("5.00")), ("x", "A", "INV", Decimal("6.00")), (None, "B", "INV", Decimal("7.00")),
                                  (None, "B", "CN", Decimal("-1.00")), ("y", "C", "CN", Decimal("-2.00"))],
                                 "country string, document_no string, doc_type string, net_amount_usd decimal(18,2)")
    df = metrics.summed(rows, ["net_revenue", "deals"], ["country"])
    assert {tuple(r) for r in df.collect()} == {("x", Decimal("11.00"), 1), (None, Decimal("6.00"), 1), ("y", Decimal("-2.00"), 0)}


def test_rep_months_are_merged_and_never_broadcast(spark):
    from attain.operators import checks
    from attain.plans import sqlviews

    m = tiny_model(spark, [line(1, "INV", 100)], {(1, 202406): 100, (2, 202406): None})
    assert plan(kpi.rep_month_base(m)).count("SortMergeJoin [rep_key") == 2 and "BroadcastHashJoin [rep_key" not in plan(kpi.rep_month_base(m))
    assert plan(sqlviews.sql_rep_months(m)).count("SortMergeJoin [rep_key") >= 1
    spine = ["rep_key", "month_key"]
    assert "BroadcastHashJoin" not in plan(checks.rows_without(m.fact_targets, spine, m.bridge, spine))
    assert {(r["rep_key"], r["actual"], r["target"]) for r in kpi.rep_month_base(m).collect()} == {(1, Decimal("100.00"), 100), (2, Decimal("0.00"), None)}


def test_targets_of_the_run_meet_the_bridge_without_a_broadcast(spark):
    run = catalog.run(spark, FOLDER)
    run.bridge, run.targets  # noqa: B018
    text = plan(run.missing_targets)
    assert "SortMergeJoin [rep_key" in text and "BroadcastHashJoin" not in text
    assert run.missing_targets.count() + run.fact_targets.select("rep_key", "month_key").distinct().count() == run.bridge.count()

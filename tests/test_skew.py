"""One order, one rep, one customer, one product and one duplicated line own a third of the rows."""

import duckdb
import pytest

import __spark_entry__ as entry
from attain.catalog import SOURCE_TABLES
from compare import connect, differences, rows_of_duck, rows_of_spark

BASE = "/root/testdata/sf0.001"
NAMES = ["rep_month_performance", "commission_rep_month", "team_month", "q09_product_line_contribution",
         "q11_month_end_loading", "q12_rep_leaderboard_latest_year", "scenario_sale_month", "concentration", "rep_ytd",
         "metrics_by_rep", "statement_lines", "sql_assertions", "dq_dedupe", "dq_rule_log", "dq_quarantine",
         "over_credit", "cn_original_join", "integrity_checks", "row_reconciliation", "fact_sales", "reconcile_kpis"]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in SOURCE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{BASE}/{name}.parquet'")
        if name not in ("lineitem", "orders"):
            con.execute(f"COPY {name} TO '{folder}/{name}.parquet' (FORMAT parquet)")
    # a hot order with many lines of one rep and product, and one line exported thousands of times
    con.execute(f"""COPY (SELECT * FROM orders UNION ALL
        SELECT 1000000000, o_custkey, o_orderstatus, o_totalprice, TIMESTAMP '2000-12-05', o_orderpriority
          FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 1)) TO '{folder}/orders.parquet' (FORMAT parquet)""")
    con.execute(f"""COPY (SELECT * FROM lineitem UNION ALL
        SELECT 1000000000, 7, 3, (1 + i)::INT, 1 + i % 50, 900.0 + i, (i % 10) / 100.0, 0.0,
               CASE WHEN i % 5 = 0 THEN 'R' ELSE 'N' END, 'O', TIMESTAMP '2000-12-20' + to_days((i % 9)::INT)
          FROM range(3000) r(i) UNION ALL
        SELECT 1000000000, 8, 4, 9000000, 1 + i % 50, 1000.0 + i % 100, 0.05, 0.0, 'N', 'O', TIMESTAMP '2000-12-20'
          FROM range(3000) r(i)) TO '{folder}/lineitem.parquet' (FORMAT parquet)""")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_whole_results_on_skewed_tables(spark, skewed, name):
    df = entry.queries()[name](spark, skewed)
    assert differences(rows_of_spark(df), rows_of_duck(connect(skewed), entry.oracle_sql()[name])) == []

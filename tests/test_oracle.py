"""Every registered query against its DuckDB statement, and the shape of the plans."""

import os
import re

import pytest

import __spark_entry__ as entry
from attain import catalog
from attain.catalog import SOURCE_TABLES
from compare import connect, differences, rows_of_duck, rows_of_spark

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_a_statement():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_its_statement(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in plan
    assert differences(rows_of_spark(df), rows_of_duck(duck, ORACLE[name])) == []


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_scans_read_only_needed_columns(spark):
    from attain.sources.ledger import LedgerModel

    m = LedgerModel(spark, FOLDER, staged=False)
    plan = m.fact_sales.groupBy("month_key").sum("net_amount_usd")._jdf.queryExecution().executedPlan().toString()
    schemas = " ".join(re.findall(r"ReadSchema: struct<[^>]*>", plan))
    for unused in ("l_tax", "l_linestatus", "o_totalprice", "o_orderpriority", "p_name", "s_acctbal"):
        assert unused not in schemas


def test_changed_input_is_read_again(spark, tmp_path):
    import shutil

    for name in SOURCE_TABLES:
        shutil.copyfile(f"{FOLDER}/{name}.parquet", tmp_path / f"{name}.parquet")
    query = QUERIES["revenue_tie_out"]
    first = query(spark, str(tmp_path)).collect()
    shutil.copyfile("/root/testdata/sf0.01/lineitem.parquet", tmp_path / "lineitem.parquet")
    old = next(m.folder for k, m in catalog._models.items() if k[2] == str(tmp_path))
    assert query(spark, str(tmp_path)).collect() != first
    assert not os.path.exists(old.removeprefix("file:"))

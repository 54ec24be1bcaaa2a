"""The driver's tables written out as messy raw extracts: a fixture for the ETL, no part of the engine.

Every raw line keeps the amounts of its line item; its text fields get the spellings, gaps and
contradictions a real export has, chosen by the remainder of the line key.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attain.functions import columns as C
from attain.plans.etl import Extracts
from attain.policy import plan_tiers
from attain.sources.ledger import LedgerModel, Tables, code, department_of, employees, first_day, fx_rate
from attain.sources.stage import store


def every(n: int, remainder: int = 0):
    return F.col("k") % n == remainder


def sales_lines(t: Tables) -> DataFrame:
    orders = t["orders"].select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"))
    lines = t["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("decimal(4,0)").alias("qty"), F.col("l_extendedprice").cast(C.MONEY).alias("value"),
        F.col("l_discount").cast("decimal(4,2)").alias("disc"), (F.col("l_returnflag") == "R").alias("credit"),
        F.to_date("l_shipdate").alias("ship_date"))
    j = (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(t["supplier"].select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
         .join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))  # one by one: their sizes are known, that of their join is not
         .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
         .withColumn("k", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
         .withColumn("day", F.when(F.col("credit"), F.col("ship_date")).otherwise(F.col("order_date"))))
    sign = F.when(F.col("credit"), F.lit(-1)).otherwise(F.lit(1))
    fx = fx_rate(F.col("r_regionkey"), F.month("day") - 1)
    j = j.withColumn("price", F.round(F.round(F.col("value") / F.col("qty"), 2).cast(C.MONEY) * fx, 2).cast(C.MONEY))
    net = F.round(F.col("qty") * F.col("price") * (1 - F.col("disc")), 2).cast(C.MONEY) * sign
    zero = every(101) & ~F.col("credit")
    flip = (every(113) & ~F.col("credit")) | (every(157) & F.col("credit"))
    cents = F.lit(Decimal("0.00")).cast(C.MONEY)
    net = F.when(zero, cents).when(every(163), F.round(net * F.lit(Decimal("1.10")) + 5, 2)).otherwise(net)
    order_no = F.col("l_orderkey").cast("string")
    kind = F.when(F.col("credit"), "CN").otherwise("INV")
    name = F.col("r_name")
    spelling = (F.when(every(151), "Atlantis").when(every(5, 1), F.lower(name))
                .when(every(5, 2), F.concat(F.lit(" Region of "), F.initcap(name), F.lit(" ")))
                .when(every(5, 3), F.concat(F.lit("r"), F.col("r_regionkey").cast("string")))
                .when(every(5, 4), F.concat(F.left(F.lower(name), F.lit(3)), F.lit("."))).otherwise(name))
    pattern = (F.when(every(4, 1), F.date_format("day", "dd/MM/yyyy")).when(every(4, 2), F.date_format("day", "yyyy/MM/dd"))
               .when(every(4, 3), F.date_format("day", "dd-MM-yyyy")).otherwise(F.date_format("day", "yyyy-MM-dd")))
    rep, sku = code("REP-", "l_suppkey"), code("SKU-", "l_partkey")
    currency = F.concat(F.lit("CCY"), F.col("r_regionkey").cast("string"))
    return j.select(
        F.col("k").cast("string").alias("line_id"), F.concat(kind, F.lit("-"), order_no).alias("document_no"),
        F.when(every(8, 3), F.concat(F.lit(" "), F.lower(kind))).otherwise(kind).alias("doc_type"),
        F.when(F.col("credit") & ~every(137), F.concat(F.lit("INV-"), order_no)).alias("original_document_no"),
        F.when(every(97), "unknown").when(every(131), "2031-01-15").otherwise(pattern).alias("document_date"),
        F.when(every(206), "  ").when(every(103), F.lit(None)).when(every(149), "REP-X")
        .when(every(9, 4), F.concat(rep, F.lit(" "))).otherwise(rep).alias("rep_code"),
        F.when(every(139), "CUST-X").otherwise(code("CUST-", "o_custkey")).alias("customer_code"),
        spelling.alias("country"),
        F.when(every(107), "SKU-UNKNOWN").when(every(6, 1), F.concat(F.lit(" "), F.lower(sku))).otherwise(sku)
        .alias("sku"),
        (F.when(every(179), F.lit(123456789)).otherwise(F.col("qty")) * sign * F.when(flip, F.lit(-1)).otherwise(F.lit(1)))
        .cast("int").cast("string").alias("quantity"),
        F.when(zero, cents).otherwise(F.col("price")).cast("string").alias("unit_list_price_local"),
        F.when(every(127), "0.75").when(every(173), "150").when(every(193), "1e30").when(every(167), "n/a").otherwise(F.col("disc").cast("string")).alias("discount_pct"),
        F.concat(net.cast(C.MONEY).cast("string"), F.when(every(181), "5").otherwise("")).alias("net_amount_local"),
        F.when(every(109), "XXX").when(every(4, 2), F.concat(F.lit(" "), F.lower(currency), F.lit(" ")))
        .otherwise(currency).alias("currency"),
        F.date_format("ship_date", "yyyy-MM-dd").alias("exported_at"))


def month_text(key):
    return F.concat((F.floor(key / 100)).cast("string"), F.lit("-"), F.lpad((key % 100).cast("string"), 2, "0"))


class LedgerExtracts(Extracts):
    """The extracts of a ledger; the lines, which most tables do not need, are written when they are first read."""

    def __init__(self, m: LedgerModel, **tables: DataFrame):
        super().__init__(m.policy, **tables)
        self._model = m

    @cached_property
    def sales_lines(self) -> DataFrame:
        m = self._model
        lines = sales_lines(m.source)
        return store(lines, "raw_sales_lines", folder=m.folder) if m.staged else lines


def ledger_extracts(m: LedgerModel) -> Extracts:
    t, policy = m.source, m.policy
    team_code = F.concat(F.lit("T"), F.lpad(F.col("team_key").cast("string"), 2, "0"))
    seats = m.fact_team_plan
    managers = t["nation"].select(
        F.concat(F.lit("MGR-"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("employee_code"),
        F.concat(F.lit("Manager "), F.col("n_name")).alias("full_name"), F.lit("Sales Manager").alias("role"),
        first_day(F.lit(-60)).alias("hire_date"), F.lit(None).cast("date").alias("exit_date"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("home_country"),
        F.concat(F.lit("T"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("managed_team_id"))
    reps = employees(t).select("employee_code", "full_name", "role", "hire_date", "exit_date",
                               F.lit(None).cast("string").alias("home_country"),
                               F.lit(None).cast("string").alias("managed_team_id"))
    year_months = F.explode(F.sequence(F.lit(policy.start), F.lit(policy.end), F.expr("interval 1 month")))
    unknown_reps = seats.where("team_key = 0").select(
        month_text(F.col("month_key")).alias("target_month"), F.lit("REP-X").alias("rep_code"),
        F.lit(Decimal("10.00")).cast(C.MONEY).alias("target_amount_usd"), F.lit(1).alias("revision_no"),
        F.lit(None).cast("date").alias("revised_at"))
    return LedgerExtracts(
        m,
        orders=t["orders"],
        sales_targets=m.raw_targets.select(
            month_text(F.col("month_key")).alias("target_month"), code("REP-", "rep_key").alias("rep_code"),
            "target_amount_usd", "revision_no", F.lit(None).cast("date").alias("revised_at")).unionByName(unknown_reps),
        team_plan=seats.select(team_code.alias("team_id"), month_text(F.col("month_key")).alias("plan_month"),
                               "planned_headcount", "plan_amount_usd"),
        employees=managers.unionByName(reps),
        rep_assignments=m.assignments.select(code("REP-", "rep_key").alias("rep_code"), team_code.alias("team_id"),
                                             "start_date", "end_date"),
        teams=t["nation"].select(
            F.concat(F.lit("T"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("team_id"),
            F.col("n_name").alias("team_name"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string"))
            .alias("country_code"), department_of("n_nationkey").alias("department_code"),
            F.lit(None).cast("int").alias("hc_2024"), F.lit(None).cast("int").alias("hc_2025"),
            F.concat(F.lit("MGR-"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("manager_code")),
        customers=t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).select(
            code("CUST-", "c_custkey").alias("customer_code"), F.col("c_name").alias("customer_name"),
            F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("country_code"),
            F.col("c_mktsegment").alias("customer_segment"), F.lit(None).cast("string").alias("industry"),
            F.lit(None).cast("string").alias("city"),
            F.concat(F.lit("T"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("owning_team_id"),
            F.lit(None).cast("date").alias("created_date")),
        products=m.dim_product.select("sku", "product_name", "product_line", "list_price_usd",
                                      F.col("unit_cost_pct").cast("decimal(6,4)").alias("unit_cost_pct")),
        fx_rates=t["region"].select("r_regionkey", year_months.alias("_m")).select(
            F.date_format("_m", "yyyy-MM").alias("fx_month"),
            F.concat(F.lit("CCY"), F.col("r_regionkey").cast("string")).alias("currency"),
            fx_rate(F.col("r_regionkey"), F.month("_m") - 1).alias("rate_per_usd")),
        commission_plans=plan_tiers(t.spark, policy).drop("plan_tier_key"))

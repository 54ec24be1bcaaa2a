"""The driver's order tables read as a sales ledger.

Orders are documents, line items are invoice or credit-note lines, suppliers are sales reps,
nations are teams, regions are markets. Every function returns a lazy DataFrame.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attain.functions import columns as C
from attain.operators.dedupe import keep_first, keep_latest, surplus_rows
from attain.operators.joins import dated_join, dealt
from attain.plans.model import Model
from attain.policy import PLAN_PHASING, RAMP_FACTORS, Plan, Policy, plan_tiers, standard_tiers
from attain.sources.stage import new_folder, store

BASE_QUOTA = {"ENT": "170000", "SME": "150000", "CHN": "160000"}
EPOCH = 1995 * 12

REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")

LEDGER_POLICY = Policy(
    start=dt.date(1995, 1, 1),
    end=dt.date(2001, 7, 31),
    plans=(
        Plan("PLAN-A", "1995-1997 Sales Incentive Plan", dt.date(1995, 1, 1), dt.date(1997, 12, 31),
             standard_tiers(0.80)),
        Plan("PLAN-B", "1998-2001 Sales Incentive Plan", dt.date(1998, 1, 1), dt.date(2001, 12, 31),
             standard_tiers(0.85)),
    ),
    strategic_lines=("PROMO", "LARGE"),
    markets=tuple((f"R{i}", name, f"CCY{i}", "EAST" if i % 2 == 0 else "WEST") for i, name in enumerate(REGIONS)),
    aliases={spelling: f"R{i}" for i, name in enumerate(REGIONS)
             for spelling in (name.lower(), f"r{i}", f"region of {name.lower()}", name.lower()[:3] + ".")},
    canonical_names=REGIONS,
    min_months_on_target=5,
    compare_years=(1999, 2000),
    home_region="EAST",
    home_label="east",
    other_label="west",
    statement_month=200012,
)


class Tables:
    """Parquet tables of one folder; each is opened once."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        return self._open[name]


def code(prefix: str, key: str, digits: int = 12):
    return F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string"), digits, "0"))


def first_day(index):
    """First day of a month counted from January 1995."""
    months = F.lit(EPOCH) + index
    return F.make_date(F.floor(months / 12).cast("int"), (months % 12 + 1).cast("int"), F.lit(1))


def department_of(nation):
    team = F.col(nation) if isinstance(nation, str) else nation
    return F.when(team % 3 == 0, "ENT").when(team % 3 == 1, "SME").otherwise("CHN")


def fx_rate(region, month0):
    """Local units per dollar: 1 + half a unit per region + a cent per calendar month."""
    return (F.lit(Decimal("1.0000")) + region * F.lit(Decimal("0.5000"))
            + month0 * F.lit(Decimal("0.0100"))).cast("decimal(10,4)")


# --------------------------------------------------------------------------- dimensions
def employees(t: Tables) -> DataFrame:
    """Sales reps with hire and exit dates derived from their key."""
    k = F.col("s_suppkey")
    hire = F.when(k % 4 == 0, k % 48).otherwise(F.lit(-24))
    leave = F.when(k % 5 == 1, F.date_add(first_day(50 + k % 30), 19))
    return t["supplier"].select(
        k.alias("rep_key"), code("REP-", "s_suppkey").alias("employee_code"), F.col("s_name").alias("full_name"),
        F.lit("Sales Representative").alias("role"), hire.cast("int").alias("hire_index"),
        first_day(hire).alias("hire_date"), leave.alias("exit_date"), F.col("s_nationkey").alias("home_team"))


def moves_team():
    return (F.col("rep_key") % 7 == 3) & (F.col("hire_index") < 42)


def assignments(t: Tables) -> DataFrame:
    """Dated team membership; some reps move to another team in July 1998."""
    moves = moves_team()
    move_day = F.lit(dt.date(1998, 7, 1))
    first = F.struct(F.col("home_team").alias("team_key"), F.col("hire_date").alias("start_date"),
                     F.when(moves, F.date_sub(move_day, 1)).otherwise(F.col("exit_date")).alias("end_date"))
    second = F.struct(((F.col("home_team") + 5) % 25).alias("team_key"), move_day.alias("start_date"),
                      F.col("exit_date").alias("end_date"))
    spans = F.when(moves, F.array(first, second)).otherwise(F.array(first))
    return (employees(t).select("rep_key", "hire_index", F.explode(spans).alias("_s"))
            .select("rep_key", "hire_index", "_s.*"))


def dim_team(t: Tables) -> DataFrame:
    return t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("team_key"), F.concat(F.lit("T"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
        .alias("team_id"), F.col("n_name").alias("team_name"), department_of("n_nationkey").alias("department_code"),
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("country_code"),
        F.col("r_name").alias("country_name"))


def dim_country(t: Tables) -> DataFrame:
    k = F.col("r_regionkey")
    return t["region"].select(
        F.concat(F.lit("R"), k.cast("string")).alias("country_code"), F.col("r_name").alias("country_name"),
        F.concat(F.lit("CCY"), k.cast("string")).alias("currency"),
        F.when(k % 2 == 0, "EAST").otherwise("WEST").alias("region"))


def dim_employee(t: Tables, policy: Policy) -> DataFrame:
    return employees(t).select(
        F.col("rep_key").alias("employee_key"), "employee_code", "full_name", "role", "hire_date", "exit_date",
        (F.col("hire_date") >= F.lit(policy.start)).cast("int").alias("is_new_hire_in_period"),
        department_of(F.when(moves_team(), (F.col("home_team") + 5) % 25).otherwise(F.col("home_team")))
        .alias("department_code"))


def dim_product(t: Tables, policy: Policy) -> DataFrame:
    strategic = F.col("p_type").isin(*policy.strategic_lines)
    return t["part"].select(
        F.col("p_partkey").alias("product_key"), code("SKU-", "p_partkey").alias("sku"),
        F.col("p_name").alias("product_name"), F.col("p_type").alias("product_line"),
        F.col("p_retailprice").cast(C.MONEY).alias("list_price_usd"),
        (F.lit(Decimal("0.30")) + F.lit(Decimal("0.05")) * (F.col("p_size") % 10)).cast("decimal(4,2)")
        .alias("unit_cost_pct"),
        strategic.cast("int").alias("is_strategic"),
        F.when(strategic, F.lit(policy.strategic_weight)).otherwise(F.lit(Decimal("1.00"))).cast("decimal(4,2)")
        .alias("commission_weight"))


def dim_customer(t: Tables) -> DataFrame:
    return t["customer"].select(
        F.col("c_custkey").alias("customer_key"), code("CUST-", "c_custkey").alias("customer_code"),
        F.col("c_name").alias("customer_name"), F.col("c_mktsegment").alias("customer_segment"))


# --------------------------------------------------------------------------- facts
def ledger_lines(t: Tables) -> DataFrame:
    """Line items with exact amounts, one row per line key."""
    lines = t["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("int").alias("quantity"), F.col("l_extendedprice").cast(C.MONEY).alias("list_value"),
        F.col("l_discount").cast("decimal(6,4)").alias("discount_pct"), "l_returnflag",
        F.to_date("l_shipdate").alias("ship_date"))
    return keep_first(lines, ["l_orderkey", "l_linenumber"])


def fact_sales(t: Tables, assigned: DataFrame, products: DataFrame, policy: Policy) -> DataFrame:
    """Clean signed ledger lines with the team of the rep on the order date."""
    orders = t["orders"].select("o_orderkey", F.col("o_custkey").alias("customer_key"),
                                F.to_date("o_orderdate").alias("order_date"))
    product = products.select("product_key", "unit_cost_pct", "commission_weight")
    credit = F.col("l_returnflag") == "R"
    sign = F.when(credit, F.lit(-1)).otherwise(F.lit(1))
    posted = F.when(credit, F.col("ship_date")).otherwise(F.col("order_date"))
    dated = (ledger_lines(t).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
             .withColumn("document_date", posted)
             .where(F.col("document_date").between(F.lit(policy.start), F.lit(policy.end))
                    & (~credit | (F.col("ship_date") >= F.col("order_date"))))
             .withColumnRenamed("l_suppkey", "rep_key").withColumnRenamed("l_partkey", "product_key"))
    owned = dated_join(dated, assigned.drop("hire_index"), "rep_key", "order_date")
    priced = (owned.join(product, "product_key")
              .withColumn("gross_amount_usd", (F.col("list_value") * sign).cast(C.MONEY))
              .withColumn("net_amount_usd", F.round(F.col("list_value") * (1 - F.col("discount_pct")) * sign, 2)
                          .cast(C.MONEY))
              .withColumn("cost_amount_usd", F.round(F.col("list_value") * F.col("unit_cost_pct") * sign, 2)
                          .cast(C.MONEY)))
    order_no = F.col("l_orderkey").cast("string")
    return priced.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"),
        F.concat(F.when(credit, "CN-").otherwise("INV-"), order_no).alias("document_no"),
        F.when(credit, "CN").otherwise("INV").alias("doc_type"),
        F.when(credit, F.concat(F.lit("INV-"), order_no)).alias("original_document_no"),
        "document_date", C.date_key(F.col("document_date")).alias("date_key"),
        C.month_key(F.col("document_date")).alias("month_key"), "rep_key", "team_key", "customer_key", "product_key",
        (F.col("quantity") * sign).alias("quantity"), "discount_pct", "gross_amount_usd",
        (F.col("gross_amount_usd") - F.col("net_amount_usd")).cast(C.MONEY).alias("discount_amount_usd"),
        "net_amount_usd", "cost_amount_usd",
        (F.col("net_amount_usd") - F.col("cost_amount_usd")).cast(C.MONEY).alias("gross_margin_usd"),
        "commission_weight",
        F.when(credit, F.datediff("ship_date", "order_date")).alias("days_since_original"),
        C.in_month_end_window(F.col("document_date"), policy.month_end_days).alias("is_month_end_window"))


def line_accounting(t: Tables, assigned: DataFrame, products: DataFrame, policy: Policy) -> DataFrame:
    """What becomes of the line items: repeats, the first reason that keeps a line out of the fact, and the rest."""
    spans = assigned.select(F.col("rep_key").alias("_rep"), "start_date", F.coalesce("end_date", F.lit(dt.date(9999, 12, 31))).alias("_end"))
    orders = t["orders"].select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))
    known = products.select(F.col("product_key").alias("_product"))
    credit = F.col("l_returnflag") == "R"
    posted = F.when(credit, F.col("ship_date")).otherwise(F.col("order_date"))
    covered = (F.col("l_suppkey") == F.col("_rep")) & F.col("order_date").between(F.col("start_date"), F.col("_end"))
    lines = (ledger_lines(t).join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
             .join(spans, covered, "left").join(known, F.col("l_partkey") == F.col("_product"), "left"))
    reason = (F.when(F.col("o_orderkey").isNull(), "order missing")
              .when(~F.coalesce(posted.between(F.lit(policy.start), F.lit(policy.end)), F.lit(False)), "outside the window")
              .when(credit & ~F.coalesce(F.col("ship_date") >= F.col("order_date"), F.lit(False)), "credit before its order")
              .when(F.col("_rep").isNull(), "rep without assignment")
              .when(F.col("_product").isNull(), "product missing").otherwise("kept"))
    repeats = surplus_rows(t["lineitem"], ["l_orderkey", "l_linenumber"], "line_items").select(F.lit("repeated").alias("outcome"), "line_items")
    return repeats.unionByName(lines.groupBy(reason.alias("outcome")).agg(F.count(F.lit(1)).alias("line_items")))


def bridge(assigned: DataFrame, policy: Policy) -> DataFrame:
    """Rep-months: every month whose 15th falls inside an assignment."""
    months = F.sequence(F.lit(policy.start), F.lit(policy.end), F.expr("interval 1 month"))
    active = F.filter(months, lambda m: (F.date_add(m, 14) >= F.col("start_date"))
                      & (F.col("end_date").isNull() | (F.date_add(m, 14) <= F.col("end_date"))))
    tenure = (C.month_index("month_key") - EPOCH - F.col("hire_index")).cast("int")
    return (dealt(assigned, "rep_key").select("rep_key", "team_key", "hire_index", F.explode(active).alias("_m"))
            .withColumn("month_key", C.month_key(F.col("_m"))).withColumn("tenure_months", tenure)
            .select("rep_key", "month_key", "team_key", "tenure_months",
                    (F.col("tenure_months") < policy.ramp_months).cast("int").alias("is_ramp_month")))


def base_quota(department, key):
    """Full monthly quota of a department: base times the phasing of the calendar month."""
    base = F.when(department == "ENT", F.lit(Decimal(BASE_QUOTA["ENT"]))).when(
        department == "SME", F.lit(Decimal(BASE_QUOTA["SME"]))).otherwise(F.lit(Decimal(BASE_QUOTA["CHN"])))
    phasing = F.element_at(F.array(*[F.lit(Decimal(p)) for p in PLAN_PHASING]), (key % 100).cast("int"))
    return base * phasing


def raw_targets(spine: DataFrame, policy: Policy) -> DataFrame:
    """Published targets with superseded and faulty revisions, before any rule has run."""
    idx = C.month_index("month_key") - EPOCH
    slot = F.col("rep_key") + idx
    ramp = F.coalesce(F.get(F.array(*[F.lit(Decimal(r)) for r in RAMP_FACTORS]), F.col("tenure_months")),
                      F.lit(Decimal("1.00")))
    quota = F.when(slot % 211 == 7, F.lit(Decimal("0"))).otherwise(
        F.round(base_quota(department_of("team_key"), F.col("month_key")) * ramp, 2)).cast(C.MONEY)
    original = F.struct(F.lit(1).alias("revision_no"),
                        F.when(slot % 20 == 0, F.round(quota * F.lit(Decimal("0.95")), 2)).otherwise(quota)
                        .cast(C.MONEY).alias("target_amount_usd"))
    revised = F.struct(F.lit(2).alias("revision_no"), quota.alias("target_amount_usd"))
    revisions = F.when(slot % 20 == 0, F.array(original, revised)).otherwise(F.array(original))
    return (spine.where(slot % 37 != 5)
            .select("rep_key", "team_key", "month_key", "is_ramp_month", F.explode(revisions).alias("_r"))
            .select("rep_key", "team_key", "month_key", "is_ramp_month", "_r.*"))


def fact_targets(published: DataFrame) -> DataFrame:
    """Latest revision per rep-month, where it is positive."""
    return keep_latest(published, ["rep_key", "month_key"], ["revision_no"]).where(F.col("target_amount_usd") > 0)


def fact_team_plan(t: Tables, policy: Policy) -> DataFrame:
    """Seats and full quota per team and month."""
    seats = t["supplier"].groupBy(F.col("s_nationkey").alias("team_key")).agg(F.count(F.lit(1)).alias("_reps"))
    months = F.sequence(F.lit(policy.start), F.lit(policy.end), F.expr("interval 1 month"))
    return (t["nation"].select(F.col("n_nationkey").alias("team_key")).join(seats, "team_key", "left")
            .withColumn("planned_headcount",
                        (F.coalesce("_reps", F.lit(0)) + F.col("team_key") % 2).cast("int"))
            .select("team_key", "planned_headcount", F.explode(months).alias("_m"))
            .withColumn("month_key", C.month_key(F.col("_m")))
            .select("team_key", "month_key", "planned_headcount",
                    (base_quota(department_of("team_key"), F.col("month_key")) * F.col("planned_headcount"))
                    .cast(C.MONEY).alias("plan_amount_usd")))


class LedgerModel(Model):
    """The star schema over the driver's tables, each part planned on first use."""

    def __init__(self, spark: SparkSession, path: str, policy: Policy = LEDGER_POLICY, staged: bool = True):
        super().__init__(policy, staged)
        C.require_exact(spark)
        self.source, self.folder = Tables(spark, path), new_folder(spark)

    tiers = cached_property(lambda self: plan_tiers(self.source.spark, self.policy))
    assignments = cached_property(lambda self: assignments(self.source))
    bridge = cached_property(lambda self: bridge(self.assignments, self.policy))
    raw_targets = cached_property(lambda self: raw_targets(self.bridge, self.policy))

    @cached_property
    def fact_sales(self) -> DataFrame:
        """Written once when staged: every KPI, question and report reads it."""
        lines = fact_sales(self.source, self.assignments, self.dim_product, self.policy)
        return store(lines, "fact_sales", ["month_key"], self.folder) if self.staged else lines

    fact_targets = cached_property(lambda self: fact_targets(self.raw_targets))
    fact_team_plan = cached_property(lambda self: fact_team_plan(self.source, self.policy))
    dim_team = cached_property(lambda self: dim_team(self.source))
    dim_country = cached_property(lambda self: dim_country(self.source))
    dim_employee = cached_property(lambda self: dim_employee(self.source, self.policy))
    dim_product = cached_property(lambda self: dim_product(self.source, self.policy))
    dim_customer = cached_property(lambda self: dim_customer(self.source))

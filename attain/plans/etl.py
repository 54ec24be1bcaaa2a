"""Raw extracts to star schema: standardise, validate, route, repair, conform, model."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attain.functions import columns as C
from attain.operators.dedupe import keep_first, keep_latest, least_rows, mark_repeats, surplus_rows
from attain.operators.joins import dealt, many, point_in_time_join, sized, spread_lookup_join
from attain.operators.keys import Key, repeats
from attain.operators.ranking import dense_key
from attain.operators.rules import DROP, FIX, FLAG, QUARANTINE, Rule, first_failed, rule_counts, rule_log
from attain.plans.model import Model
from attain.policy import Policy, values
from attain.schema import RAW, model_columns
from attain.sources.io import project, read_raw
from attain.sources.stage import new_folder, remove, store

REP_ROLE, MANAGER_ROLE = "Sales Representative", "Sales Manager"


class Extracts:
    """The ten raw tables with the policy they are judged by."""

    def __init__(self, policy: Policy, **tables: DataFrame):
        missing = {name for name in RAW.keys() - tables.keys() if not hasattr(type(self), name)}
        if missing:
            raise ValueError(f"missing extracts {sorted(missing)}")
        self.policy = policy
        self.__dict__.update(tables)

    @classmethod
    def from_csv(cls, spark: SparkSession, folder: str, policy: Policy) -> "Extracts":
        return cls(policy, **read_raw(spark, folder))

    @property
    def spark(self) -> SparkSession:
        return self.teams.sparkSession


# --------------------------------------------------------------------------- rules
def is_type(kind: str) -> Column:
    return F.col("doc_type") == kind


def misses(amount: str) -> Column:
    return F.coalesce(F.col(amount), F.lit(0)) == 0


def net_gap() -> Column:
    expected = F.col("quantity") * F.col("unit_list_price_local") * (1 - F.col("discount_pct"))
    return F.abs(expected - F.col("net_amount_local")) > F.abs(F.col("net_amount_local")) * F.lit(0.01).cast(
        "decimal(3,2)") + 1


DUPLICATE = Rule("DQ-S01", "sales_lines", "Line exported more than once", "HIGH", DROP)

SALES_RULES = [
    Rule("DQ-S02", "sales_lines", "Document date missing or unreadable", "CRITICAL", QUARANTINE,
         lambda p: F.col("document_date").isNull()),
    Rule("DQ-S03", "sales_lines", "Document date outside the reporting window", "HIGH", QUARANTINE,
         lambda p: ~F.col("document_date").between(F.lit(p.start), F.lit(p.end))),
    Rule("DQ-S04", "sales_lines", "Rep code missing", "CRITICAL", QUARANTINE,
         lambda p: F.col("rep_code").isNull() | (F.trim("rep_code") == "")),
    Rule("DQ-S05", "sales_lines", "Rep code unknown", "HIGH", QUARANTINE,
         lambda p: F.col("rep_code").isNotNull() & ~F.col("known_rep")),
    Rule("DQ-S06", "sales_lines", "SKU unknown", "HIGH", QUARANTINE, lambda p: ~F.col("known_sku")),
    Rule("DQ-S07", "sales_lines", "Customer unknown", "HIGH", QUARANTINE, lambda p: ~F.col("known_customer")),
    Rule("DQ-S08", "sales_lines", "Currency without exchange rates", "HIGH", QUARANTINE,
         lambda p: ~F.col("known_currency")),
    Rule("DQ-S09", "sales_lines", "Country not a known market", "HIGH", QUARANTINE,
         lambda p: F.col("country_code").isNull()),
    Rule("DQ-S10", "sales_lines", "Invoice with negative quantity", "HIGH", QUARANTINE,
         lambda p: is_type("INV") & ((F.col("quantity") < 0) | F.col("impossible_amount"))),
    Rule("DQ-S11", "sales_lines", "Credit note with positive quantity", "HIGH", QUARANTINE,
         lambda p: is_type("CN") & ((F.col("quantity") > 0) | F.col("impossible_amount"))),
    Rule("DQ-S12", "sales_lines", "Credit note without original invoice", "MEDIUM", QUARANTINE,
         lambda p: is_type("CN") & F.col("original_document_no").isNull()),
    Rule("DQ-S13", "sales_lines", "Invoice line without price, repaired from the list price", "MEDIUM", FIX,
         lambda p: is_type("INV") & (misses("unit_list_price_local") | misses("net_amount_local"))),
    Rule("DQ-S14", "sales_lines", "Discount outside 0-60%", "MEDIUM", QUARANTINE,
         lambda p: F.coalesce((F.col("discount_pct") < 0) | (F.col("discount_pct") > F.lit(0.60).cast("decimal(3,2)")),
                              F.lit(False)) | F.col("impossible_discount")),
    Rule("DQ-S15", "sales_lines", "Net amount off by more than 1%", "MEDIUM", FLAG,
         lambda p: net_gap() & ~misses("unit_list_price_local")),
]

POST_RULES = [
    Rule("DQ-S16", "sales_lines", "Rep without a team on the document date", "HIGH", QUARANTINE,
         lambda p: is_type("INV") & F.col("team_id").isNull()),
    Rule("DQ-S17", "sales_lines", "Credit note whose invoice is missing or quarantined", "HIGH", QUARANTINE,
         lambda p: is_type("CN") & F.col("original_date").isNull()),
    Rule("DQ-S18", "sales_lines", "Credit notes exceed their invoice", "HIGH", QUARANTINE,
         lambda p: is_type("CN") & F.col("original_date").isNotNull() & F.col("over_credited")),
]

SUPERSEDED = Rule("DQ-T01", "targets", "Superseded target revision", "LOW", DROP)
TARGET_RULES = [
    Rule("DQ-T02", "targets", "Target not positive", "HIGH", QUARANTINE,
         lambda p: F.coalesce(F.col("target_amount_usd"), F.lit(0)) <= 0),
    Rule("DQ-T03", "targets", "Target for an unknown rep", "HIGH", QUARANTINE, lambda p: ~F.col("known_rep")),
]
MISSING_TARGET = Rule("DQ-T04", "targets", "Active rep-month without target", "HIGH", FLAG)

#: The rules that ask a master, in the order of attach_masters: the code they ask for and what they are told.
CODE_RULES = {"DQ-S05": ("rep_code", "known_rep"), "DQ-S06": ("sku", "known_sku"), "DQ-S07": ("customer_code", "known_customer"),
              "DQ-S08": ("currency", "known_currency")}

#: What lines get from their product.
PRODUCT = ("product_key", "list_price_usd", "unit_cost_pct", "commission_weight")

#: The rule that holds back invoice lines whose repaired amounts would not fit.
UNFIT = "DQ-S10"

STANDARDS = [
    Rule("STD-01", "sales_lines", "Dates brought to ISO form", "LOW", FIX, lambda p: F.col("fixed_date")),
    Rule("STD-02", "sales_lines", "Country spellings mapped to market codes", "LOW", FIX,
         lambda p: F.col("fixed_country")),
    Rule("STD-03", "sales_lines", "SKUs trimmed and upper-cased", "LOW", FIX, lambda p: F.col("fixed_sku")),
]


# --------------------------------------------------------------------------- standardise
def alias_lookup(text: Column, aliases: dict[str, str]) -> Column:
    """Policy spellings as a constant map: no join, no lookup table to ship."""
    pairs = [F.lit(x) for pair in aliases.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.trim(text)))


# Wide enough for any plausible entry; rounding to cents comes with the dollar amounts.
QUANTITY, AMOUNT, SHARE = "decimal(14,4)", "decimal(16,4)", "decimal(10,6)"
# A repaired net is a product of the three; beyond this type the line stays unrepaired and is held back.
REPAIRED = "decimal(18,4)"


def standardise_sales(df: DataFrame, policy: Policy, *more: Column | str) -> DataFrame:
    """Typed and cleaned lines, with a flag per kind of correction made, and more columns of df as they are.

    Text that is no number becomes null. A number that does not fit its column (or is not finite) is marked as
    impossible, so that a rule holds the line back.
    """
    sku = F.upper(F.trim("sku"))
    iso = F.coalesce(F.col("document_date").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))
    parsed = C.parse_dates(F.col("document_date"))
    country = alias_lookup(F.col("country"), policy.aliases)
    canonical = F.coalesce(F.col("country").isin(*policy.canonical_names), F.lit(False))

    def number(column: str, kind: str) -> Column:
        return F.col(column).try_cast(kind).alias(column)

    def impossible(column: str, kind: str) -> Column:
        return F.col(column).try_cast(kind).isNull() & F.col(column).try_cast("double").isNotNull()

    return df.select(
        "line_id", "document_no", F.upper(F.trim("doc_type")).alias("doc_type"), "original_document_no",
        parsed.alias("document_date"), F.trim("rep_code").alias("rep_code"), "customer_code",
        country.alias("country_code"), sku.alias("sku"), number("quantity", QUANTITY),
        number("unit_list_price_local", AMOUNT), number("discount_pct", SHARE),
        number("net_amount_local", AMOUNT), F.coalesce(F.upper(F.trim("currency")), F.lit("")).alias("currency"),
        (~iso & parsed.isNotNull()).alias("fixed_date"), (~canonical & country.isNotNull()).alias("fixed_country"),
        F.coalesce(sku != F.col("sku"), F.lit(False)).alias("fixed_sku"),
        (impossible("quantity", QUANTITY) | impossible("unit_list_price_local", AMOUNT)
         | impossible("net_amount_local", AMOUNT)).alias("impossible_amount"),
        impossible("discount_pct", SHARE).alias("impossible_discount"), *more)


def known(master: DataFrame, code: str, name: str, flag: str, *attributes: str) -> DataFrame:
    return master.select(F.col(code).alias(name), *attributes, F.lit(True).alias(flag))


def attach_masters(lines: DataFrame, reps: DataFrame, products: DataFrame, customers: DataFrame,
                   currencies: DataFrame, strangers: dict[str, DataFrame] | None = None) -> DataFrame:
    """Left joins to the masters; what was found is carried along so that no master is joined twice.

    With strangers (the codes of lines that no product or customer has, each once) lines are told from these, which are few
    unless the extract is broken: lines do not move to meet masters of any size, and get no attributes of them.
    """
    flags = ["known_rep", "known_sku", "known_customer", "known_currency"]
    joined = lines.join(reps, "rep_code", "left")
    if strangers is None:
        joined = joined.join(products, "sku", "left").join(customers, "customer_code", "left")
    else:
        for code, flag in (("sku", "known_sku"), ("customer_code", "known_customer")):
            met = joined.join(strangers[code].withColumn("_strange", F.lit(True)), code, "left")
            joined = met.withColumn(flag, F.col(code).isNotNull() & F.col("_strange").isNull()).drop("_strange")
    joined = joined.join(currencies, "currency", "left")
    return joined.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in flags})


# --------------------------------------------------------------------------- the run
class Run:
    """One pass from extracts to star schema; every stage is a lazy table planned on first use."""

    def __init__(self, x: Extracts, staged: bool = False):
        self.x, self.policy, self.staged = x, x.policy, staged
        C.require_exact(x.spark)
        self.folder = new_folder(x.spark)

    def keep(self, df: DataFrame, name: str, split: str | None = None) -> DataFrame:
        """Stages several others read are written once."""
        return store(df, name, folder=self.folder, split=split) if self.staged else df

    def close(self) -> None:
        """Delete what the run has staged; its tables cannot be read afterwards."""
        remove(self.x.spark, self.folder)

    # masters with surrogate keys
    @cached_property
    def employees(self) -> DataFrame:
        return self.keep(dense_key(self.x.employees, "employee_code", "employee_key", self.folder), "employees")

    @cached_property
    def products(self) -> DataFrame:
        strategic = F.col("product_line").isin(*self.policy.strategic_lines)
        weight = F.when(strategic, F.lit(self.policy.strategic_weight)).otherwise(F.lit(1)).cast("decimal(4,2)")
        return self.keep(dense_key(self.x.products.withColumn("is_strategic", strategic.cast("int"))
                                   .withColumn("commission_weight", weight), "sku", "product_key", self.folder), "products")

    @cached_property
    def customers(self) -> DataFrame:
        return self.keep(dense_key(self.x.customers, "customer_code", "customer_key", self.folder), "customers")

    @cached_property
    def teams(self) -> DataFrame:
        return self.keep(dense_key(self.x.teams, "team_id", "team_key", self.folder), "teams")

    @cached_property
    def masters(self) -> tuple[DataFrame, ...]:
        """What lines are looked up in, as attach_masters takes it."""
        reps = sized(self.employees).where(F.col("role") == REP_ROLE)
        return (known(reps, "employee_code", "rep_code", "known_rep", "employee_key"),
                known(sized(self.products), "sku", "sku", "known_sku", *PRODUCT),
                known(sized(self.customers), "customer_code", "customer_code", "known_customer", "customer_key"),
                known(self.x.fx_rates.select("currency").distinct(), "currency", "currency", "known_currency"))

    @cached_property
    def codes_repeat(self) -> bool:
        """Whether a master has a code twice. A line then meets several rows of it, and both its counts and the one of its
        repeats that stays are settled after the joins; otherwise repeats go before, and lines are counted where they are."""
        keys = [Key(c, master, (c,), F.col(c).isNotNull()) for c, master in zip(("rep_code", "sku", "customer_code"), self.masters)]
        return not repeats(keys).isEmpty()

    @cached_property
    def strangers(self) -> dict[str, DataFrame]:
        """The codes of lines that no product or no customer has, each once."""
        lines = standardise_sales(self.x.sales_lines, self.policy)

        def of(code: str, master: DataFrame) -> DataFrame:
            codes = lines.where(F.col(code).isNotNull()).select(code).distinct()
            return sized(self.keep(codes.join(master, code, "left_anti"), f"strange_{code}"))

        return {"sku": of("sku", self.masters[1]), "customer_code": of("customer_code", self.masters[2])}

    def with_products(self, lines: DataFrame) -> DataFrame:
        """Lines with the attributes of their product, unless they have them."""
        return lines if "product_key" in lines.columns else lines.join(self.masters[1].drop("known_sku"), "sku", "left")

    def checked(self, raw: DataFrame, *more: Column | str) -> DataFrame:
        """Raw lines standardised, with what the masters know of them and a flag per correction and row rule."""
        lines = attach_masters(standardise_sales(raw, self.policy, *more), *self.masters, None if self.codes_repeat else self.strangers)
        flags = {r.rule_id: r.flag(self.policy) for r in STANDARDS + SALES_RULES}
        return lines.withColumns(flags).drop(
            "known_rep", "known_sku", "known_customer", "known_currency", "fixed_date", "fixed_country", "fixed_sku",
            "impossible_amount", "impossible_discount")

    @cached_property
    def all_lines(self) -> DataFrame:
        """Every exported line, repeats included, for masters with a code twice. Lines whose id may repeat are marked; only
        these carry their raw columns, which settle the one that stays."""
        x = self.x
        raw = mark_repeats(x.sales_lines, ["line_id"], "again")
        order = F.when(F.col("again"), F.struct(*[c for c in x.sales_lines.columns if c != "line_id"])).alias("raw")
        return self.keep(self.checked(raw, order, "again"), "checked_lines", split="again")

    @cached_property
    def unique(self) -> DataFrame:
        """Checked lines without repeats: of these the first in the order of the raw columns stays."""
        if not self.codes_repeat:
            return self.checked(keep_first(self.x.sales_lines, ["line_id"]))
        columns = [c for c in self.all_lines.columns if c not in ("line_id", "raw", "again")]
        once = self.all_lines.where("NOT again").select("line_id", *columns)
        return once.unionByName(least_rows(self.all_lines.where("again").select("line_id", "raw", *columns), ["line_id"])
                                .select("line_id", *columns))

    @cached_property
    def kept(self) -> DataFrame:
        """Lines without repeats: the quarantine rules each one breaks, exchange rate, repaired price, own team and the
        document it belongs to."""
        held_back = [F.when(F.col(f"`{r.rule_id}`"), F.lit(r.rule_id)) for r in SALES_RULES if r.action == QUARANTINE]
        lines = self.unique.withColumns({"failed": F.concat_ws(";", *held_back), "repair": F.col("`DQ-S13`"),
                                    "fx_month": F.date_format("document_date", "yyyy-MM")})
        fx = self.x.fx_rates.select("fx_month", "currency", F.col("rate_per_usd").alias("fx_rate"))
        priced = lines.join(fx, ["fx_month", "currency"], "left")
        if self.codes_repeat:
            return self.keep(held_unfit(self.placed(repair_price(priced))), "kept_lines")
        lines = self.keep(self.placed(priced), "kept_lines", split="repair")
        broken = self.keep(repair_price(self.with_products(lines.where("repair"))).drop(*PRODUCT), "repaired_lines")
        whole = lines.where("NOT repair").withColumn("list_price_usd", F.lit(None).cast(C.MONEY))
        return held_unfit(repair_price(whole).drop("list_price_usd").unionByName(broken))

    def placed(self, lines: DataFrame) -> DataFrame:
        """Lines with their own team and the document they belong to."""
        placed = point_in_time_join(lines, self.x.rep_assignments, "rep_code", "document_date", "team_id", window=(self.policy.start, self.policy.end))
        cn = is_type("CN")
        return placed.withColumns({
            "team_id": F.when(~cn, F.col("team_id")),
            "doc": F.when(cn, F.col("original_document_no")).otherwise(F.col("document_no"))}).drop(
            "fx_month", *[r.rule_id for r in STANDARDS + SALES_RULES])

    @cached_property
    def documents(self) -> DataFrame:
        """Per original document: team and date of its first accepted invoice line, invoiced and credited value.

        The comparison runs on exact unrounded quotients; the shown totals are sums of lines rounded to cents.
        """
        cn = is_type("CN")
        usd = F.col("net_amount_local") / F.col("fx_rate")
        cents = F.round(usd, 2).cast(C.MONEY)
        return (self.kept.where(F.col("failed") == "").groupBy("doc")
                .agg(F.count(F.lit(1)).alias("lines"), F.min(F.when(~cn, F.struct("line_id", "team_id", "document_date"))).alias("_first"),
                     F.sum(F.when(~cn, usd)).alias("invoiced"), F.sum(F.when(cn, -usd)).alias("credited"),
                     F.sum(F.when(~cn, cents)).alias("invoiced_usd"), F.sum(F.when(cn, -cents)).alias("credited_usd"))
                .select("doc", "lines", "invoiced_usd", "credited_usd", F.col("_first.team_id").alias("invoice_team"),
                        F.col("_first.document_date").alias("invoice_date"),
                        F.coalesce(F.col("credited") > F.coalesce("invoiced", F.lit(0)) + 1, F.lit(False))
                        .alias("over_credited")))

    @cached_property
    def routed(self) -> DataFrame:
        """Every kept line with the rules that hold it back: all broken row rules, else the first late rule.

        Only credit notes that passed the row rules meet the documents, and only these are written again.
        """
        cn, undated = F.coalesce(is_type("CN"), F.lit(False)), F.lit(None).cast("date")
        held = self.kept.where(F.col("failed") != "").withColumns({"original_date": undated, "late": F.lit(False)})
        passed = self.kept.where(F.col("failed") == "")
        documents = self.documents.drop("invoiced_usd", "credited_usd")
        notes = spread_lookup_join(passed.where(cn), documents, "doc", "lines", ["line_id"]).withColumns({
            "team_id": F.col("invoice_team"), "original_date": F.col("invoice_date")}).drop("invoice_team", "invoice_date")
        others = passed.where(~cn).withColumns({"original_date": undated, "over_credited": F.lit(False)})

        def judged(lines: DataFrame) -> DataFrame:
            return lines.withColumns({"late": F.lit(True), "failed": first_failed(POST_RULES, self.policy)}).drop("over_credited")

        return self.keep(judged(notes), "routed_notes").unionByName(judged(others)).unionByName(held)

    @cached_property
    def clean(self) -> DataFrame:
        return usd_economics(self.with_products(self.routed.where(F.col("failed") == "")), self.policy)

    @cached_property
    def quarantine(self) -> DataFrame:
        return self.routed.where(F.col("failed") != "").select(
            "line_id", "document_no", "doc_type", "original_document_no", "document_date", "rep_code",
            "customer_code", "country_code", "sku", "quantity", "unit_list_price_local", "discount_pct",
            "net_amount_local", "currency", F.col("failed").alias("dq_failed_rules"))

    @cached_property
    def repeats(self) -> DataFrame:
        """How many lines repeat an id, and how many lines there are."""
        if not self.codes_repeat:
            return surplus_rows(self.x.sales_lines, ["line_id"], "dropped_duplicates")
        surplus = surplus_rows(self.all_lines.where("again"), ["line_id"], "dropped_duplicates").select("dropped_duplicates")
        return surplus.withColumn("_total", self.all_lines.agg(F.count(F.lit(1))).scalar())

    # logs
    @cached_property
    def line_counts(self) -> DataFrame:
        """One row: how many exported lines, repeats included, each correction and row rule touches.

        Rules on a line itself are counted where it is read. Of the others each asks for one code only: lines are counted per
        code, and the codes are looked up.
        """
        if self.codes_repeat:
            return rule_counts(self.all_lines, {r.rule_id: F.col(f"`{r.rule_id}`") for r in STANDARDS + SALES_RULES})
        lines = standardise_sales(self.x.sales_lines, self.policy)
        counts = rule_counts(lines, {r.rule_id: r.flag(self.policy) for r in STANDARDS + SALES_RULES if r.rule_id not in CODE_RULES})
        for (rule_id, (code, flag)), master in zip(CODE_RULES.items(), self.masters):
            rule = next(r for r in SALES_RULES if r.rule_id == rule_id)
            codes = (lines.groupBy(code).agg(F.count(F.lit(1)).alias("_n")).join(master.select(code, flag), code, "left")
                     .withColumn(flag, F.coalesce(flag, F.lit(False))))
            broken = codes.agg(F.coalesce(F.sum(F.when(rule.flag(self.policy), F.col("_n"))), F.lit(0)))
            counts = counts.withColumn(rule_id, broken.scalar())
        return counts

    @cached_property
    def sales_log(self) -> DataFrame:
        """Corrections, row rules and late rules with the rows each one touched."""
        counts = self.line_counts
        late = rule_counts(self.routed, {"unfit": F.col("unfit"), **{r.rule_id: F.col("failed") == r.rule_id for r in POST_RULES}},
                           "_accepted")
        counts = counts.withColumn(UNFIT, F.col(f"`{UNFIT}`") + late.select("unfit").scalar())
        raw = self.x.sales_lines.agg(F.count(F.lit(1))).scalar()
        return (rule_log(counts, SALES_RULES, STANDARDS)
                .unionByName(rule_log(self.repeats.withColumnRenamed("dropped_duplicates", "DQ-S01"), [DUPLICATE]))
                .unionByName(rule_log(late.withColumn("_total", raw), POST_RULES)))

    @cached_property
    def checked_targets(self) -> DataFrame:
        people = known(self.x.employees, "employee_code", "rep_code", "known_rep")
        return self.x.sales_targets.join(people, "rep_code", "left").withColumn(
            "known_rep", F.coalesce("known_rep", F.lit(False)))

    @cached_property
    def latest_targets(self) -> DataFrame:
        return keep_latest(self.checked_targets, ["rep_code", "target_month"], ["revision_no"], "copies")

    @cached_property
    def targets(self) -> DataFrame:
        """Latest revisions that pass the target rules."""
        broken = TARGET_RULES[0].flag(self.policy) | TARGET_RULES[1].flag(self.policy)
        return self.latest_targets.where(~broken).drop("copies", "known_rep")

    @cached_property
    def target_log(self) -> DataFrame:
        counts = rule_counts(self.checked_targets, {r.rule_id: r.flag(self.policy) for r in TARGET_RULES})
        old = surplus_rows(self.x.sales_targets, ["rep_code", "target_month"], "DQ-T01")
        gaps = (self.missing_targets.agg(F.count(F.lit(1)).alias("DQ-T04"))
                .withColumn("_total", self.bridge.agg(F.count(F.lit(1))).scalar()))
        return (rule_log(old, [SUPERSEDED]).unionByName(rule_log(counts, TARGET_RULES))
                .unionByName(rule_log(gaps, [MISSING_TARGET])))

    @cached_property
    def rule_log(self) -> DataFrame:
        return self.sales_log.unionByName(self.target_log)

    @cached_property
    def reconciliation(self) -> DataFrame:
        """raw = clean + quarantined + dropped, as one row."""
        routed = self.routed.agg(C.count_if(F.col("failed") != "").alias("quarantined"),
                                 C.count_if(F.col("failed") == "").alias("clean_rows"))
        repeats = self.repeats.agg(F.max("dropped_duplicates")).scalar()
        raw = self.x.sales_lines.agg(F.count(F.lit(1))).scalar()
        one = routed.select(raw.alias("raw_rows"), repeats.alias("dropped_duplicates"), "quarantined", "clean_rows")
        whole = F.col("dropped_duplicates") + F.col("quarantined") + F.col("clean_rows")
        return one.withColumn("balanced", F.col("raw_rows") == whole)

    # model
    @cached_property
    def dim_team(self) -> DataFrame:
        departments = values(self.x.spark, list(self.policy.departments),
                             {"department_code": "string", "department_name": "string"})
        markets = values(self.x.spark, [m[:2] for m in self.policy.markets],
                         {"country_code": "string", "country_name": "string"})
        managers = self.x.employees.where(F.col("role") == MANAGER_ROLE).select(
            F.col("employee_code").alias("manager_code"), F.col("full_name").alias("manager_name"))
        return project(self.teams.join(departments, "department_code").join(markets, "country_code")
                       .join(managers, "manager_code", "left"), model_columns("dim_team"), "dim_team")

    @cached_property
    def dim_employee(self) -> DataFrame:
        latest = (self.x.rep_assignments.groupBy(F.col("rep_code").alias("employee_code"))
                  .agg(F.max_by("team_id", "start_date").alias("_team")))
        teams = self.x.teams.select(F.col("team_id").alias("current_team_id"), "manager_code", "country_code",
                                    "department_code")
        last_day = F.coalesce("exit_date", F.lit(self.policy.end))
        tenure = F.datediff(last_day, "hire_date") / F.lit(30.44)
        joined = (self.employees.join(latest, "employee_code", "left")
                  .withColumn("current_team_id", F.coalesce("_team", "managed_team_id"))
                  .join(teams, "current_team_id", "left"))
        return project(joined.withColumns({
            "manager_code": F.when(F.col("role") != MANAGER_ROLE, F.col("manager_code")),
            "employment_status": F.when(F.col("exit_date").isNotNull(), "Exited").otherwise("Active"),
            "tenure_band": C.tenure_band(tenure),
            "is_new_hire_in_period": (F.col("hire_date") >= F.lit(self.policy.start)).cast("int")}),
            model_columns("dim_employee"), "dim_employee")

    @cached_property
    def dim_product(self) -> DataFrame:
        return project(self.products, model_columns("dim_product"), "dim_product")

    @cached_property
    def dim_customer(self) -> DataFrame:
        return project(self.customers, model_columns("dim_customer"), "dim_customer")

    @cached_property
    def dim_country(self) -> DataFrame:
        return values(self.x.spark, list(self.policy.markets),
                      {"country_code": "string", "country_name": "string", "currency": "string", "region": "string"})

    @cached_property
    def dim_department(self) -> DataFrame:
        return values(self.x.spark, list(self.policy.departments),
                      {"department_code": "string", "department_name": "string"})

    @cached_property
    def bridge(self) -> DataFrame:
        """Active rep-months: each assignment is spread over the months whose 15th it covers."""
        months = F.sequence(F.trunc(F.lit(self.policy.start), "MM"), F.lit(self.policy.end), F.expr("interval 1 month"))
        covered = F.filter(months, lambda m: (F.date_add(m, 14) >= F.col("start_date"))
                           & (F.col("end_date").isNull() | (F.date_add(m, 14) <= F.col("end_date"))))
        people = self.employees.where(F.col("role") == REP_ROLE).select(
            F.col("employee_code").alias("rep_code"), F.col("employee_key").alias("rep_key"), "hire_date")
        seats = self.x.rep_assignments.join(people, "rep_code").join(self.teams.select("team_id", "team_key"), "team_id")
        spread = (dealt(seats, "rep_key").select("rep_key", "team_key", "hire_date", F.explode(covered).alias("_m")))
        tenure = ((F.year("_m") - F.year("hire_date")) * 12 + F.month("_m") - F.month("hire_date")).cast("int")
        rows = spread.withColumn("month_key", C.month_key(F.col("_m"))).withColumn("tenure_months", tenure)
        ramp = (F.col("tenure_months") < self.policy.ramp_months).cast("int")
        return self.keep(rows.withColumn("is_ramp_month", ramp).select(*model_columns("bridge")), "bridge")

    @cached_property
    def fact_sales(self) -> DataFrame:
        teams = self.teams.select("team_id", "team_key")
        day, lines = F.col("document_date"), self.clean
        if "customer_key" not in lines.columns:
            lines = lines.join(self.masters[2].select("customer_code", "customer_key"), "customer_code", "left")
        keyed = (lines.join(teams, "team_id", "left")
                 .withColumns({"date_key": C.date_key(day), "month_key": C.month_key(day),
                               "rep_key": F.col("employee_key"), "quantity": F.col("quantity").cast("long"),
                               "unit_list_price_usd": F.round(F.col("unit_list_price_local") / F.col("fx_rate"), 2)
                               .cast(C.MONEY)}))
        return self.keep(project(keyed, model_columns("fact_sales"), "fact_sales"), "etl_fact_sales")

    @cached_property
    def fact_targets(self) -> DataFrame:
        people = self.employees.select(F.col("employee_code").alias("rep_code"), F.col("employee_key").alias("rep_key"))
        keyed = (many(self.targets).join(people, "rep_code")
                 .withColumn("month_key", F.regexp_replace("target_month", "-", "").cast("int"))
                 .join(many(self.bridge.select("rep_key", "month_key", "team_key", "is_ramp_month")),
                       ["rep_key", "month_key"], "left")
                 .withColumn("date_key", F.col("month_key") * 100 + 1))
        return self.keep(project(keyed, model_columns("fact_targets"), "fact_targets"), "etl_fact_targets")

    @cached_property
    def fact_team_plan(self) -> DataFrame:
        keyed = (self.x.team_plan.join(self.teams.select("team_id", "team_key"), "team_id")
                 .withColumn("month_key", F.regexp_replace("plan_month", "-", "").cast("int"))
                 .withColumn("date_key", F.col("month_key") * 100 + 1))
        return project(keyed, model_columns("fact_team_plan"), "fact_team_plan")

    @cached_property
    def missing_targets(self) -> DataFrame:
        return self.bridge.join(many(self.fact_targets.select("rep_key", "month_key")), ["rep_key", "month_key"], "left_anti")

    @cached_property
    def tiers(self) -> DataFrame:
        """The plan extract, one row per plan and tier; pay, bands and clawback windows all follow from it."""
        order = F.concat(F.date_format("effective_from", "yyyyMMdd"), F.lit("|"), "plan_id", F.lit("|"),
                         F.lpad(F.col("tier_order").cast("string"), 10, "0"))
        return dense_key(self.x.commission_plans.withColumn("_order", order), "_order", "plan_tier_key", self.folder).drop("_order")

    @cached_property
    def model(self) -> Model:
        return Model(self.policy, tiers=self.tiers, fact_sales=self.fact_sales,
                     fact_targets=self.fact_targets, fact_team_plan=self.fact_team_plan, bridge=self.bridge,
                     dim_team=self.dim_team, dim_country=self.dim_country, dim_department=self.dim_department, dim_employee=self.dim_employee,
                     dim_product=self.dim_product, dim_customer=self.dim_customer)


def repair_price(lines: DataFrame) -> DataFrame:
    """Lines flagged for repair get the list price in local currency and the net that follows from it.

    Where either does not fit its column the line keeps the amounts it came with and is marked unfit.
    """
    price = F.round(F.col("list_price_usd") * F.col("fx_rate"), 2).try_cast(AMOUNT)
    net = F.round(F.col("quantity") * F.col("_price") * (1 - F.col("discount_pct")), 2)
    fits = F.col("_net").try_cast(REPAIRED)
    known = F.col("list_price_usd").isNotNull() & F.col("fx_rate").isNotNull()
    unfit = F.col("repair") & known & (F.col("_price").isNull() | (F.col("_net").isNotNull() & fits.isNull()))
    mended = F.col("repair") & ~F.col("unfit")
    return (lines.withColumn("_price", price).withColumn("_net", net).withColumn("unfit", unfit).withColumns({
        "unit_list_price_local": F.when(mended, F.col("_price")).otherwise(F.col("unit_list_price_local")),
        "net_amount_local": F.when(mended, fits).otherwise(F.col("net_amount_local").cast(REPAIRED))}).drop("_price", "_net"))


def held_unfit(lines: DataFrame) -> DataFrame:
    """Lines whose repair is unfit are held back, unless a rule does so already."""
    alone = F.col("unfit") & (F.col("failed") == "")
    return lines.withColumns({"failed": F.when(alone, F.lit(UNFIT)).otherwise(F.col("failed")), "unfit": alone})


def usd_economics(lines: DataFrame, policy: Policy) -> DataFrame:
    """Dollar amounts of clean lines, each rounded to cents before the next is derived from it."""
    gross = F.round(F.col("quantity") * F.col("unit_list_price_local") / F.col("fx_rate"), 2).cast(C.MONEY)
    net = F.round(F.col("net_amount_local") / F.col("fx_rate"), 2).cast(C.MONEY)
    cost = F.round(F.col("quantity") * F.col("list_price_usd") * F.col("unit_cost_pct"), 2).cast(C.MONEY)
    return (lines.withColumns({"gross_amount_usd": gross, "net_amount_usd": net, "cost_amount_usd": cost})
            .withColumns({
                "discount_amount_usd": (F.col("gross_amount_usd") - F.col("net_amount_usd")).cast(C.MONEY),
                "gross_margin_usd": (F.col("net_amount_usd") - F.col("cost_amount_usd")).cast(C.MONEY),
                "days_since_original": F.datediff("document_date", "original_date"),
                "is_month_end_window": C.in_month_end_window(F.col("document_date"), policy.month_end_days)}))


def calendar(bounds: DataFrame, policy: Policy) -> DataFrame:
    """One row per day between the first and last date of a one-row table."""
    day = F.col("date")
    dates = bounds.select("first_date", F.explode(F.sequence("first_date", "last_date", F.expr("interval 1 day")))
                          .alias("date"))
    return dates.select(
        C.date_key(day).alias("date_key"), "date", F.year(day).alias("year"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter"), F.month(day).alias("month_num"),
        F.date_format(day, "MMM").alias("month_name"), C.month_key(day).alias("month_key"),
        F.date_format(day, "yyyy-MM").alias("year_month"), F.trunc(day, "MM").alias("month_start_date"),
        F.dayofmonth(day).alias("day_of_month"), F.dayofmonth(F.last_day(day)).alias("days_in_month"),
        F.date_format(day, "EEEE").alias("weekday_name"),
        C.in_month_end_window(day, policy.month_end_days).alias("is_month_end_window"),
        ((F.year(day) - F.year("first_date")) * 12 + F.month(day)).alias("month_index"))


def process_sales(x: Extracts) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Clean lines, quarantined lines, rule log and row reconciliation."""
    run = Run(x)
    return run.clean, run.quarantine, run.sales_log, run.reconciliation


def process_targets(x: Extracts) -> tuple[DataFrame, DataFrame]:
    run = Run(x)
    return run.targets, run.target_log


def require_balanced(reconciliation: DataFrame) -> None:
    """Stop the run when rows were lost or invented."""
    row = reconciliation.first()
    if not row["balanced"]:
        raise ValueError(f"row reconciliation failed: {row.asDict()}")

"""Integrity checks, assertions, declared constraints and reconciliation of two results.

Every check is an aggregate or an anti join over whole tables; what comes back is one row per check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attain.functions import columns as C
from attain.operators.dedupe import surplus_rows
from attain.operators.joins import many, one_row
from attain.operators.keys import Key, repeats, stacked, unknown, with_known
from attain.schema import CONSTRAINTS, Constraint


def rows_failing(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(C.count_if(condition).alias("failing_rows"))


def rows_without(df: DataFrame, keys: list[str], parent: DataFrame, parent_keys: list[str]) -> DataFrame:
    """Rows of df whose keys are not in the parent; a null key counts as missing.

    The rows are counted per key first, so a key held by a large share of the rows is one row in
    the join.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    known = parent.select(*[F.col(p).alias(k) for p, k in zip(parent_keys, keys)])
    missing = per_key.join(many(known), keys, "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("failing_rows"))


def as_check(check_id: str, description: str, failing: DataFrame) -> DataFrame:
    return failing.select(F.lit(check_id).alias("check_id"), F.lit(description).alias("description"),
                          F.col("failing_rows").cast("long").alias("failing_rows"),
                          (F.col("failing_rows") == 0).alias("passed"))


def stack(checks: list[DataFrame]) -> DataFrame:
    return stacked([c.select("check_id", "description", "failing_rows", "passed") for c in checks])


def one_pass(df: DataFrame, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """Several row conditions of one table in a single scan."""
    counts = df.agg(*[C.count_if(bad).alias(check_id) for check_id, _, bad in checks])
    entries = F.array(*[F.struct(F.lit(i).alias("check_id"), F.lit(d).alias("description"),
                                 F.col(f"`{i}`").cast("long").alias("failing_rows")) for i, d, _ in checks])
    rows = counts.select(F.explode(entries).alias("_c")).select("_c.*")
    return rows.withColumn("passed", F.col("failing_rows") == 0)


def key_checks(spark, unique: list[tuple[str, str, Key]] = (), refer: list[tuple[str, str, Key, Key]] = ()) -> DataFrame:
    """Checks (id, description, key) that keys are unique, and (id, description, key, parent) that they are known.

    Null keys are no repeats of their own kind only where the key's condition leaves them out, and never unknown.
    """
    parts = [repeats([Key(i, k.table, k.columns, k.where) for i, _, k in unique])] if unique else []
    parts += [unknown([(Key(i, k.table, k.columns, k.where), parent) for i, _, k, parent in refer])] if refer else []
    listed = F.array(*[F.struct(F.lit(c[0]).alias("what"), F.lit(c[1]).alias("description")) for c in (*unique, *refer)])
    named = spark.range(1).select(F.explode(listed).alias("_c")).select("_c.what", "_c.description", F.lit(0).cast("long").alias("failing_rows"))
    found = [p.select("what", F.lit(None).cast("string").alias("description"), F.col("failing_rows").cast("long").alias("failing_rows")) for p in parts]
    rows = (stacked([named, *found]).groupBy(F.col("what").alias("check_id"))
            .agg(F.max("description").alias("description"), F.sum("failing_rows").alias("failing_rows")))
    return rows.withColumn("passed", F.col("failing_rows") == 0)


def document_sides(fs: DataFrame) -> DataFrame:
    """Per document, in one scan: its lines, its invoice lines and value, and the credit lines and value that refer to it."""
    cn, net = F.col("doc_type") == "CN", F.col("net_amount_usd")
    own = F.struct(F.col("document_no").alias("doc"), F.lit(1).alias("line"), F.when(~cn, 1).otherwise(0).alias("invoice"),
                   net.alias("invoiced"), F.lit(0).alias("credit"), F.lit(None).cast("decimal(18,2)").alias("credited"))
    refers = F.struct(F.col("original_document_no").alias("doc"), F.lit(0).alias("line"), F.lit(0).alias("invoice"),
                      F.lit(None).cast("decimal(18,2)").alias("invoiced"), F.lit(1).alias("credit"), (-net).cast("decimal(18,2)").alias("credited"))
    sides = F.when(cn, F.array(own, refers)).otherwise(F.array(own))
    return (fs.select(F.explode(sides).alias("_s")).select("_s.*").groupBy("doc")
            .agg(*[F.sum(c).alias(c) for c in ("line", "invoice", "invoiced", "credit", "credited")]))


MASTERS = {"product": ("dim_product", "product_key", "product_key"), "rep": ("dim_employee", "rep_key", "employee_key"),
           "team": ("dim_team", "team_key", "team_key"), "customer": ("dim_customer", "customer_key", "customer_key")}


def integrity_checks(m) -> DataFrame:
    """Eleven checks of the conformed model; the fact is scanned three times: line ids, row conditions with known keys, documents."""
    fs, invoice = m.fact_sales, F.col("doc_type") == "INV"
    gap = F.abs(F.col("gross_amount_usd") - F.col("discount_amount_usd") - F.col("net_amount_usd"))
    cent = F.lit("0.01").cast("decimal(3,2)")
    ordered = F.coalesce(F.col("days_since_original") >= 0, F.lit(False))
    missing = F.when((F.col("line") == 0) | F.col("doc").isNull(), F.col("credit")).otherwise(0)
    documents = document_sides(fs).agg(F.coalesce(F.sum(missing), F.lit(0)).alias("failing_rows"))
    flagged = with_known(fs, {f"_known_{w}": (column, getattr(m, table), key) for w, (table, column, key) in MASTERS.items()})
    return stack([
        key_checks(m.spark, unique=[("IC-01", "line ids are unique", Key("line", fs, ("line_id",))),
                                    ("IC-09", "one target per rep-month", Key("target", m.fact_targets, ("rep_key", "month_key")))]),
        one_pass(flagged, [
            *[(i, f"{w} keys exist", ~F.col(f"_known_{w}")) for i, w in (("IC-02", "product"), ("IC-03", "rep"), ("IC-04", "team"), ("IC-05", "customer"))],
            ("IC-06", "invoices positive, credit notes negative",
             invoice != F.coalesce(F.col("net_amount_usd") > 0, F.lit(False))),
            ("IC-07", "gross - discount = net", ~F.coalesce(gap < cent, F.lit(False))),
            ("IC-08", "cost within gross",
             F.abs("cost_amount_usd") > F.abs("gross_amount_usd") + cent),
            ("IC-11", "credit notes not before their invoice", ~invoice & ~ordered)]),
        as_check("IC-10", "credit notes reference a document present", documents),
    ])


def sql_assertions(m) -> DataFrame:
    """Nine assertions on the loaded model; any failing row stops a run."""
    fs, kind, net = m.fact_sales, F.col("doc_type"), F.col("net_amount_usd")
    gap = F.abs(F.col("gross_amount_usd") - F.col("discount_amount_usd") - net)
    spine = ["rep_key", "month_key"]
    orphan = F.when((F.col("invoice") == 0) | F.col("doc").isNull(), F.col("credit")).otherwise(0)
    over = (F.col("credited") > F.col("invoiced") + 1) & F.col("doc").isNotNull()
    documents = one_row_checks(document_sides(fs), [
        ("A04", "credit notes to a missing invoice", F.sum(orphan)),
        ("A05", "credit notes above their invoice", F.count(F.when(over, 1)))])
    allocated = m.fact_targets.groupBy("team_key", "month_key").agg(F.sum("target_amount_usd").alias("allocated"))
    above = m.fact_team_plan.join(allocated, ["team_key", "month_key"]).where(
        F.col("allocated") > F.col("plan_amount_usd") * F.lit("1.25").cast("decimal(3,2)"))
    masters = {f"_known_{w}": (column, getattr(m, table), key) for w, (table, column, key) in MASTERS.items()}
    unknown_key = reduce(lambda a, b: a | b, [~F.col(flag) for flag in masters])
    return stack([
        key_checks(m.spark, unique=[("A01", "repeated sales lines", Key("line", fs, ("line_id",)))]),
        as_check("A08", "invoices outside active months", rows_without(fs.where(kind == "INV"), spine, m.bridge, spine)),
        one_pass(with_known(fs, masters), [
            ("A03", "lines with an unknown product, rep, team or customer", unknown_key),
            ("A02", "sign convention", ((kind == "INV") & (net <= 0)) | ((kind == "CN") & (net >= 0))),
            ("A06", "gross - discount <> net", gap > F.lit("0.01").cast("decimal(3,2)"))]),
        documents,
        as_check("A07", "targets outside active months", rows_without(m.fact_targets, spine, m.bridge, spine)),
        as_check("A09", "allocated targets above 125% of plan", above.agg(F.count(F.lit(1)).alias("failing_rows"))),
    ])


def one_row_checks(df: DataFrame, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """Several aggregates of one table, each the failing rows of a check, in a single pass."""
    counts = df.agg(*[F.coalesce(failing, F.lit(0)).alias(check_id) for check_id, _, failing in checks])
    entries = F.array(*[F.struct(F.lit(i).alias("check_id"), F.lit(d).alias("description"),
                                 F.col(f"`{i}`").cast("long").alias("failing_rows")) for i, d, _ in checks])
    return counts.select(F.explode(entries).alias("_c")).select("_c.*").withColumn("passed", F.col("failing_rows") == 0)


def constraint_violations(m, constraints: tuple[Constraint, ...] = CONSTRAINTS) -> DataFrame:
    """Declared constraints as counted violations: one scan of each table for its conditions, all keys of all tables together."""
    checks, unique, refer = [], [], []
    by_table: dict[str, list[tuple[str, Constraint]]] = {}
    for i, c in enumerate(constraints, start=1):
        by_table.setdefault(c.table, []).append((f"CON-{i:02d}", c))
    for table, declared in by_table.items():
        df = getattr(m, table)
        conditions = [(i, c.label, F.col(c.columns[0]).isNull() if c.kind == "NOT NULL" else ~F.expr(c.check))
                      for i, c in declared if c.kind in ("NOT NULL", "CHECK")]
        if conditions:
            checks.append(one_pass(df, conditions))
        for i, c in declared:
            if c.kind in ("PK", "UNIQUE"):
                unique.append((i, c.label, Key(i, df, c.columns, F.col(c.columns[0]).isNotNull() if c.kind == "UNIQUE" else None)))
            elif c.kind == "FK":
                refer.append((i, c.label, Key(i, df, c.columns), Key(i, getattr(m, c.parent[0]), (c.parent[1],))))
    if unique or refer:
        checks.append(key_checks(df.sparkSession, unique, refer))
    return stack(checks)


def require_passed(checks: DataFrame, what: str) -> None:
    """Gate: collects the few failed check rows and stops the run when there are any."""
    failed = [r["check_id"] for r in checks.where(~F.col("passed")).select("check_id").collect()]
    if failed:
        raise ValueError(f"{what} failed: {failed}")


# --------------------------------------------------------------------------- reconciliation
def checksums(df: DataFrame, nodes: list[str], keys: list[str], tolerances: dict[str, float | None], total: str | None) -> DataFrame:
    """Per node: rows, order-free checksums of their keys and values, and the total. Values with a tolerance count by its grid."""
    def cell(column: str) -> Column:
        step = tolerances[column]
        return F.col(column) if step is None else F.rint(F.col(column).cast("double") / F.lit(step)) if step else F.col(column).cast("double")

    h = df.select(*nodes, *([total] if total and total not in nodes else []), F.xxhash64(*keys, *[cell(c) for c in tolerances]).alias("_h"))
    return h.groupBy(*nodes).agg(F.count(F.lit(1)).alias("rows"), F.bit_xor("_h").alias("hash"),
                                 F.sum(F.shiftrightunsigned("_h", 32)).alias("sum"), *([F.sum(total).alias("total")] if total else []))


def differing_nodes(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both sides' checksums side by side, with a flag for nodes that differ; columns other than those of checksums name the node."""
    nodes = [c for c in left.columns if c not in ("rows", "hash", "sum", "total")]
    values = [c for c in left.columns if c not in nodes]
    a = left.select(*nodes, *[F.col(c).alias(f"l_{c}") for c in values])
    b = right.select(*[F.col(c).alias(f"_r_{c}") for c in nodes], *[F.col(c).alias(f"r_{c}") for c in values])
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in nodes])
    apart = reduce(lambda x, y: x | y, [~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")) for c in ("rows", "hash", "sum")])
    named = [F.when(F.col("l_rows").isNull(), F.col(f"_r_{c}")).otherwise(F.col(c)).alias(c) for c in nodes]
    return a.join(b, same, "full_outer").select(*named, *[f"{s}_{c}" for c in values for s in "lr"], apart.alias("differs"))


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], tolerances: dict[str, float | None],
              total: str | None = None, nodes: list[str] | None = None) -> DataFrame:
    """Compare two results: one row per column with the rows that differ.

    A tolerance of None asks for equality. Keys present on one side only are reported by the
    row_count check, which an inner join would hide. Nulls equal each other.

    Both sides are first reduced to checksums per node (the columns named, a bounded list such as teams and months, or one
    of 1024 hash buckets of the key). Equal checksums mean rows that agree within their tolerances; rows meet each other
    only below nodes that differ, and where none does nothing is read again.
    """
    compared = list(tolerances)
    if not nodes:
        bucket = F.pmod(F.xxhash64(*keys), F.lit(1024)).alias("_bucket")
        left, right, nodes = left.select("*", bucket), right.select("*", bucket), ["_bucket"]
    tree = differing_nodes(*[checksums(df, nodes, keys, tolerances, total) for df in (left, right)])
    apart = tree.where("differs").select(*[F.col(c).alias(f"_n_{c}") for c in nodes])
    inside = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in nodes])

    def below(df: DataFrame, side: str) -> DataFrame:
        rows = df.join(F.broadcast(apart), inside, "left_semi")
        return rows.select(*keys, *[F.col(c).alias(f"{side}_{c}") for c in compared], F.lit(True).alias("_left" if side == "l" else "_right"))

    both = below(left, "l").join(below(right, "r"), keys, "full_outer")
    paired = F.col("_left").isNotNull() & F.col("_right").isNotNull()

    def differs(column: str) -> Column:
        a, b, tolerance = F.col(f"l_{column}"), F.col(f"r_{column}"), tolerances[column]
        if tolerance is None:
            return paired & ~a.eqNullSafe(b)
        near = F.abs(a.cast("double") - b.cast("double")) <= tolerance
        return paired & ~((a.isNull() & b.isNull()) | F.coalesce(near, F.lit(False)))

    counts = both.agg(C.count_if(~paired).alias("row_count"), *[C.count_if(differs(c)).alias(f"n_{c}") for c in compared])
    if total:
        sums = tree.agg(*[F.round(F.sum(f"{side}_total").cast("double"), 2).alias(f"_{side}") for side in "lr"])
        counts = one_row(counts, sums)
    entries = F.array(*[F.struct(F.lit(name).alias("check"), F.col(col).cast("long").alias("differing_rows"))
                        for name, col in [("row_count", "row_count")] + [(c, f"n_{c}") for c in compared]])
    shown = [F.col("_l").alias("left_total"), F.col("_r").alias("right_total")] if total else []
    return counts.select(F.explode(entries).alias("_c"), *shown).select(
        "_c.check", (F.col("_c.differing_rows") == 0).alias("passed"), "_c.differing_rows",
        *(["left_total", "right_total"] if total else []))

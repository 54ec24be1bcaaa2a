"""Operators against brute force, on data with hot keys and ties."""

import datetime as dt
import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from attain.functions import columns as C
from attain.operators import checks
from attain.operators.dedupe import keep_first, keep_latest, surplus_rows
from attain.operators.joins import band_join, dated_join, one_row, point_in_time_join, spread_lookup_join
from attain.operators.ranking import dense_key, group_rank, top_rows
from attain.operators.rules import FLAG, QUARANTINE, Rule, evaluate, failed_ids, first_failed
from attain.policy import Policy
from attain.sources.io import first_rows, seeded_sample
from attain.sources.stage import shared_folder


def hot_rows(n=3000, seed=3):
    """A third of all rows hold one value of one group; negative, tiny and huge values besides."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append((i, "a", 0.0))
        else:
            value = r.choice([r.uniform(-2, 2), r.uniform(0, 1e-5), r.uniform(-1e9, 1e9), 1.0, -0.0, None])
            rows.append((i, r.choice("abc"), value))
    return rows


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("descending", [True, False])
def test_group_rank_equals_pandas(spark, by, descending):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "id int, g string, v double").repartition(7)
    got = group_rank(df, by, "v", rank="r", dense="d", descending=descending).toPandas().set_index("id")
    pdf = pd.DataFrame(rows, columns=["id", "g", "v"]).set_index("id")
    groups = pdf.groupby("g")["v"] if by else pdf["v"]
    for column, method in (("r", "min"), ("d", "dense")):
        want = groups.rank(method=method, ascending=not descending)
        pd.testing.assert_series_equal(got[column].astype(float).sort_index(), want, check_names=False, check_index_type=False)


@pytest.mark.parametrize("share", [0.2, 0.37, 0.9, 0.0001])
def test_top_rows_settles_ties_by_key(spark, share):
    rows = [(i, float(v)) for i, v in enumerate([5, 5, 3, 3, 3, 3, 3, 1, 0, 0, 0, 0, 7])]
    got = {r["id"] for r in top_rows(spark.createDataFrame(rows, "id long, v double"), "v", "id", share).collect()}
    k = max(1, round(share * len(rows)))
    assert got == {i for i, _ in sorted(rows, key=lambda x: (-x[1], x[0]))[:k]}


def test_ranks_of_nan_and_infinities(spark):
    values = [1.0, float("nan"), float("inf"), -float("inf"), None, 1e300, float("nan")]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, i int")
    out = group_rank(df, [], "v", rank="r", dense="d")
    assert out.columns == ["v", "i", "r", "d"]
    assert {r["i"]: (r["r"], r["d"]) for r in out.collect()} == {0: (5, 4), 1: (1, 1), 2: (3, 2), 3: (6, 5), 4: (None, None), 5: (4, 3), 6: (1, 1)}


@pytest.mark.parametrize("codes", [
    [f"C-{i:08d}" for i in random.Random(1).sample(range(5_000_000), 500)],
    ["A", "AAAAAAB", "B", "C10", "C9", "", "SEC-1", "SEC-10", "SEC-2", "é", "z" * 50]])
def test_dense_key_follows_code_order(spark, codes):
    df = spark.createDataFrame([(c,) for c in codes], "code string").repartition(5)
    got = {r["code"]: r["k"] for r in dense_key(df, "code", "k").collect()}
    assert got == {c: i for i, c in enumerate(sorted(codes, key=lambda c: c.encode()), start=1)}
    assert dense_key(df.limit(0), "code", "k").count() == 0


def test_keep_first_with_one_key_holding_a_third(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i % 40}", i * 7919 % 1000, None if i % 5 == 0 else f"x{i}") for i in range(3000)]
    got = {r["k"]: (r["a"], r["b"], r["n"]) for r in
           keep_first(spark.createDataFrame(rows, "k string, a int, b string").repartition(6), ["k"], "n").collect()}
    want = {}
    for k, a, b in rows:
        order = (a, b is not None, b or "")
        best, count = want.get(k, (None, 0))
        want[k] = (min(best, order) if best else order, count + 1)
    assert got == {k: (o[0], o[2] if o[1] else None, n) for k, (o, n) in want.items()}


def test_surplus_and_latest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")], "k string, rev int, v string")
    assert surplus_rows(df, ["k"], "s").collect()[0].asDict() == {"s": 2, "_total": 4}
    assert {r["k"]: r["v"] for r in keep_latest(df, ["k"], ["rev"]).collect()} == {"a": "z", "b": "q"}


def test_point_in_time_join_takes_the_latest_covering_start(spark):
    r = random.Random(5)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    spans = []
    for rep in "abc":
        for start in r.sample(range(300), 12):
            spans.append((rep, f"T{start}", day(start), None if r.random() < 0.2 else day(start + r.randint(0, 120))))
    probes = [(i, r.choice("abcd"), day(r.randint(-5, 400))) for i in range(400)] + [(999, "a", None), (998, None, day(3))]
    got = {x["id"]: x["team"] for x in point_in_time_join(
        spark.createDataFrame(probes, "id int, rep string, at date"),
        spark.createDataFrame(spans, "rep string, team string, start_date date, end_date date"), "rep", "at", "team").collect()}
    assert len(got) == len(probes)
    for i, rep, at in probes:
        covering = [(s, t) for p, t, s, e in spans if rep == p and at and s <= at and (e is None or at <= e)]
        assert got[i] == (max(covering)[1] if covering else None)


WINDOW = (dt.date(2024, 3, 1), dt.date(2024, 9, 30))


@pytest.mark.parametrize("window", [None, WINDOW, (dt.date(2030, 1, 1), dt.date(2030, 1, 31))])
def test_any_window_gives_the_same_history(spark, window):
    r = random.Random(6)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    spans = [(rep, f"T{i}", day(start), None if r.random() < 0.2 else day(start + r.randint(-3, 200)))
             for rep in "abc" for i, start in enumerate(r.sample(range(500), 40))] + [("a", "none", None, day(5)), (None, "x", day(1), None)]
    probes = [(i, r.choice("abcd"), day(r.randint(-40, 700))) for i in range(500)] + [(999, "a", None), (998, None, day(3))]
    out = point_in_time_join(spark.createDataFrame(probes, "id int, rep string, at date"),
                             spark.createDataFrame(spans, "rep string, team string, start_date date, end_date date"), "rep", "at", "team", window=window)
    got = {x["id"]: x["team"] for x in out.collect()}
    assert out.columns[-1] == "team" and len(got) == len(probes)
    for i, rep, at in probes:
        covering = [(s, t) for p, t, s, e in spans if rep and rep == p and at and s and s <= at and (e is None or at <= e)]
        assert got[i] == (max(covering)[1] if covering else None)


def test_ten_thousand_intervals_of_one_key(spark):
    from attain.operators.joins import interval_lists

    days = spark.range(10_000).select(F.lit("hot").alias("rep"), F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("id").cast("int")).alias("start_date"),
                                      F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("id") + 3).cast("int")).alias("end_date"),
                                      F.concat(F.lit("T"), F.col("id").cast("string")).alias("team"))
    window = (dt.date(2000, 1, 1), dt.date(2027, 12, 31))
    lists = interval_lists(days, "rep", "start_date", "end_date", "team", window).select(F.size("_history").alias("n"))
    assert lists.agg(F.max("n")).first()[0] <= 35 and lists.count() > 300
    lines = spark.range(60_000).select("id", F.lit("hot").alias("rep"), F.date_add(F.lit(dt.date(2000, 1, 1)), F.pmod(F.col("id") * 7, F.lit(10_010)).cast("int")).alias("at"))
    joined = point_in_time_join(lines, days, "rep", "at", "team", window=window)
    wrong = joined.withColumn("n", F.datediff("at", F.lit(dt.date(2000, 1, 1)))).where(
        ~F.col("team").eqNullSafe(F.when(F.col("n") < 10_003, F.concat(F.lit("T"), F.least(F.col("n"), F.lit(9_999)).cast("string")))))
    assert joined.count() == 60_000 and wrong.count() == 0


def test_dated_join_for_disjoint_histories(spark):
    spans = spark.createDataFrame([(1, "A", dt.date(2024, 1, 1), dt.date(2024, 6, 30)), (1, "B", dt.date(2024, 7, 1), None)],
                                  "rep int, team string, start_date date, end_date date")
    lines = spark.createDataFrame([(1, 1, dt.date(2024, 6, 30)), (2, 1, dt.date(2024, 7, 1)), (3, 1, dt.date(2023, 1, 1))],
                                  "id int, rep int, at date")
    assert {r["id"]: r["team"] for r in dated_join(lines, spans, "rep", "at").collect()} == {1: "A", 2: "B"}


def test_band_join_edges(spark):
    bands = spark.createDataFrame([("p", "low", None, 1.0), ("p", "mid", 1.0, 2.0), ("p", "top", 2.0, None)],
                                  "plan string, band string, band_floor double, band_ceiling double")
    values = [-500.0, 0.999, 1.0, 1.999, 2.0, 1e6, None]
    df = spark.createDataFrame(list(enumerate(["p"] * len(values))), "id int, plan string").join(
        spark.createDataFrame(list(enumerate(values)), "id int, v double"), "id")
    got = [r["band"] for r in band_join(df, bands, "plan", "v").orderBy("id").collect()]
    assert got == ["low", "low", "mid", "mid", "top", "top", None]


@pytest.mark.parametrize("text, day", [
    ("2024-03-09", dt.date(2024, 3, 9)), (" 2024-3-9 ", dt.date(2024, 3, 9)), ("09/03/2024", dt.date(2024, 3, 9)),
    ("9/3/2024", dt.date(2024, 3, 9)), ("2024/03/09", dt.date(2024, 3, 9)), ("09-03-2024", dt.date(2024, 3, 9)),
    ("2024-02-30", None), ("31/02/2024", None), ("03/31/2024", None), ("09/03-2024", None), ("2024/03-09", None),
    ("2024-03", None), ("2024-03-09T10", None), ("2024-01-1T", None), ("2024-1-1 x", None), ("n/a", None), ("", None),
    (None, None), ("20240309", None)])
def test_parse_dates(spark, text, day):
    row = spark.createDataFrame([(text,)], "t string").select(C.parse_dates(F.col("t")).alias("d")).first()
    assert row["d"] == day


def test_ratio_guards(spark):
    df = spark.createDataFrame([(1, Decimal("10"), Decimal("0")), (2, Decimal("1"), Decimal("4")), (3, None, Decimal("4"))],
                               "i int, a decimal(9,2), b decimal(9,2)")
    assert [r[0] for r in df.orderBy("i").select(C.ratio("a", "b")).collect()] == [None, 0.25, None]


def test_month_arithmetic(spark):
    df = spark.createDataFrame([(202401,), (202412,), (199907,)], "m int")
    rows = df.select("m", C.month_index("m").alias("i"), C.key_of_index(C.month_index("m") + 1).alias("next"),
                     C.quarter_key("m").alias("q")).collect()
    assert [(r["next"], r["q"]) for r in rows] == [(202402, 20241), (202501, 20244), (199908, 19993)]


def test_bands(spark):
    values = [0.59, 0.6, 0.8, 1.0, 1.2, 1.5, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(C.achievement_band(F.col("v"), numbered=True)).collect()]
    assert got == ["1 <60%", "2 60-79%", "3 80-99%", "4 100-119%", "5 120-149%", "6 150%+", "No Target"]


RULES = [Rule("R1", "t", "negative", "HIGH", QUARANTINE, lambda p: F.col("v") < 0),
         Rule("R2", "t", "large", "HIGH", QUARANTINE, lambda p: F.abs("v") > 10),
         Rule("R3", "t", "odd", "LOW", FLAG, lambda p: F.col("v") % 2 == 1)]


def test_rules_are_independent_and_unknown_passes(spark):
    df = spark.createDataFrame([(1, -20), (2, 11), (3, 3), (4, None)], "i int, v int")
    flagged, log = evaluate(df, RULES, Policy())
    assert {r["rule_id"]: (r["rows_affected"], r["pct_of_rows"]) for r in log.collect()} == {
        "R1": (1, 25.0), "R2": (2, 50.0), "R3": (2, 50.0)}
    assert [(r["R1"], r["R2"], r["R3"]) for r in flagged.orderBy("i").collect()] == [
        (True, True, False), (False, True, True), (False, False, True), (False, False, False)]
    ids = df.orderBy("i").select(failed_ids(RULES, Policy(), QUARANTINE), first_failed(RULES, Policy())).collect()
    assert [tuple(r) for r in ids] == [("R1;R2", "R1"), ("R2", "R2"), ("", "R3"), ("", "")]


def test_rules_on_no_rows(spark):
    _, log = evaluate(spark.createDataFrame([], "i int, v int"), RULES, Policy())
    assert all((r["rows_affected"], r["pct_of_rows"]) == (0, 0.0) for r in log.collect())


def test_reconcile_reports_values_and_missing_keys(spark):
    left = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, None), (3, 3.0, "c")], "k int, x double, y string")
    right = spark.createDataFrame([(1, 1.005, "a"), (2, 2.5, None), (4, 3.0, "c")], "k int, x double, y string")
    got = {r["check"]: (r["passed"], r["differing_rows"], r["left_total"]) for r in
           checks.reconcile(left, right, ["k"], {"x": 0.01, "y": None}, "x").collect()}
    assert got == {"row_count": (False, 2, 6.0), "x": (False, 1, 6.0), "y": (True, 0, 6.0)}
    checks.require_passed(checks.reconcile(left, left, ["k"], {"x": 0.0}).withColumnRenamed("check", "check_id"), "self")
    with pytest.raises(ValueError, match="x"):
        checks.require_passed(checks.reconcile(left, right, ["k"], {"x": 0.01}).withColumnRenamed("check", "check_id"), "x")


def test_missing_parents_count_rows_not_keys(spark):
    df = spark.createDataFrame([(1,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "p int")
    assert checks.rows_without(df, ["k"], parent, ["p"]).first()[0] == 3


def test_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    picks = [sorted(r["k"] for r in seeded_sample(df.repartition(n), "k", 20, 7).collect()) for n in (1, 5, 13)]
    assert picks[0] == picks[1] == picks[2] and len(set(picks[0])) == 20
    assert sorted(r["k"] for r in seeded_sample(df, "k", 20, 8).collect()) != picks[0]
    assert [r["k"] for r in first_rows(df, 3, "k").collect()] == [0, 1, 2]


def test_one_row_side_by_side(spark):
    a, b = spark.range(1).select(F.lit(1).alias("x")), spark.range(1).select(F.lit("s").alias("y"), F.lit(None).cast("int").alias("z"))
    assert one_row(a, b).first().asDict() == {"x": 1, "y": "s", "z": None}


def test_stage_folder_is_one_per_session(spark):
    assert shared_folder(spark) == shared_folder(spark)


def test_session_settings_stay_as_they_are(spark):
    from attain import catalog

    before = dict(spark.conf.getAll)
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        catalog.model(spark, folder)
    assert dict(spark.conf.getAll) == before


def test_silent_overflow_is_refused(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            C.require_exact(spark)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    C.require_exact(spark)


def test_one_changed_cent_is_found_and_named(spark):
    r = random.Random(8)
    rows = [(i, r.choice([None, 1, 2, 3]), r.choice([202401, 202402]), Decimal(r.randrange(10**6)).scaleb(-2), r.random(), r.choice(["a", None])) for i in range(400)]
    schema = "k int, team int, month int, paid decimal(18,2), share double, tier string"
    left = spark.createDataFrame(rows, schema).repartition(3)
    tolerances = {"paid": 0.001, "share": 1e-9, "tier": None}
    shaken = spark.createDataFrame([(*x[:4], x[4] + 1e-16, x[5]) for x in reversed(rows)], schema)

    def result(other, nodes):
        return {x["check"]: x["differing_rows"] for x in checks.reconcile(left, other, ["k"], tolerances, "paid", nodes).collect()}

    changed = shaken.withColumn("paid", F.when(F.col("k") == 77, F.col("paid") + F.lit("0.01").cast("decimal(18,2)")).otherwise(F.col("paid")))
    moved = shaken.withColumn("team", F.when(F.col("k") == 5, 9).otherwise(F.col("team")))
    for nodes in (None, ["team", "month"]):
        assert set(result(shaken, nodes).values()) == {0}
        assert result(changed, nodes) == {"row_count": 0, "paid": 1, "share": 0, "tier": 0}
        assert result(shaken.where("k <> 3 AND k <> 4"), nodes)["row_count"] == 2
        assert set(result(moved, nodes).values()) == {0}  # the team is no compared column
    sums = [checks.checksums(df, ["team", "month"], ["k"], tolerances, "paid") for df in (left, changed)]
    tree = checks.differing_nodes(*sums).where("differs").collect()
    assert [(x["team"], x["month"]) for x in tree] == [rows[77][1:3]] and tree[0]["r_total"] - tree[0]["l_total"] == Decimal("0.01")
    totals = checks.reconcile(left, changed, ["k"], tolerances, "paid").first()
    assert totals["right_total"] - totals["left_total"] == pytest.approx(0.01)


def test_a_heavy_document_is_spread_over_tasks(spark):
    n = 30_000
    lines = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"d{i % 500}") for i in range(n)]
    df = spark.createDataFrame(lines, "line_id int, doc string").repartition(16)
    lookup = df.where("doc IS NOT NULL AND doc <> 'd2'").groupBy("doc").agg(F.count("*").alias("lines"), F.min("line_id").alias("first"))
    want = {r["doc"]: r["first"] for r in lookup.collect()}
    saved = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spread_lookup_join(df, lookup, "doc", "lines", ["line_id"], heavy_rows=100)
        got = joined.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert len(got) == n
    assert {r["line_id"]: (r["doc"], r["first"]) for r in got} == {i: (d, want.get(d)) for i, d in lines}
    assert set(joined.columns) == {"line_id", "doc", "first"}
    tasks = pd.Series([r["task"] for r in got]).value_counts()
    assert tasks.max() < 0.05 * n

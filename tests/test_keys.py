"""Key tests on fingerprints and bitmaps against plain counting."""

import random
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from attain.operators import keys
from attain.operators.checks import constraint_violations
from attain.operators.dedupe import keep_first, mark_repeats
from attain.operators.keys import Key, repeats, unknown, with_known
from attain.schema import Constraint


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def surplus(values):
    return sum(n - 1 for n in Counter(values).values())


def found(df):
    return {r["what"]: r["failing_rows"] for r in df.collect()}


def test_repeats_of_many_keys_at_once(spark):
    r = random.Random(1)
    rows = [(i, None if r.random() < 0.1 else r.randrange(40), r.choice(["a", "a|b", "b|c", "c", "", None]), r.choice(["c", "b|c", "", None]), r.choice([0.0, -0.0, 1.5]))
            for i in range(900)] + [(7, 1, "x", "y", 2.0)]
    df = spark.createDataFrame(rows, "i long, k int, s string, t string, d double").repartition(5)
    got = found(repeats([Key("i", df, ("i",)), Key("k", df, ("k",)), Key("present", df, ("k",), F.col("k").isNotNull()),
                         Key("pair", df, ("s", "t")), Key("mixed", df, ("k", "s")), Key("clean", df.limit(1), ("s", "t"))]))
    assert got == {"i": 1, "k": surplus(x[1] for x in rows), "present": surplus(x[1] for x in rows if x[1] is not None),
                   "pair": surplus(x[2:4] for x in rows), "mixed": surplus(x[1:3] for x in rows)}


def test_texts_with_separators_are_different_keys(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a|", "b|c")], "s string, t string")
    model = SimpleNamespace(pairs=df)
    declared = (Constraint("pairs", "PK", ("s", "t")), Constraint("pairs", "UNIQUE", ("s",)))
    assert [r["failing_rows"] for r in constraint_violations(model, declared).orderBy("check_id").collect()] == [0, 0]
    model.pairs = df.union(df.limit(1))
    assert sorted(r["failing_rows"] for r in constraint_violations(model, declared).collect()) == [1, 1]


@pytest.mark.parametrize("words", [1, 4, 1 << 20])
def test_colliding_bits_only_cost_time(spark, monkeypatch, words):
    monkeypatch.setattr(keys, "WORDS", words)
    r = random.Random(2)
    rows = [("hot" if i % 3 == 0 else f"k{r.randrange(600)}", i * 7919 % 1000, None if i % 5 == 0 else f"x{i}") for i in range(1500)]
    df = spark.createDataFrame(rows, "k string, a int, b string").repartition(6)
    want = {}
    for k, a, b in rows:
        order = (a, b is not None, b or "")
        best, n = want.get(k, (order, 0))
        want[k] = (min(best, order), n + 1)
    got = {x["k"]: (x["a"], x["b"], x["n"]) for x in keep_first(df, ["k"], "n").collect()}
    assert got == {k: (o[0], o[2] if o[1] else None, n) for k, (o, n) in want.items()}
    assert found(repeats([Key("k", df, ("k",))])) == {"k": surplus(x[0] for x in rows)}
    marked = mark_repeats(df, ["k"], "again")
    assert marked.columns == ["k", "a", "b", "again"]
    assert all(x["again"] for x in marked.collect() if want[x["k"]][1] > 1)


def test_rows_of_single_keys_are_not_shuffled(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "k long, v string")
    text = plan(keep_first(df, ["k"]))
    assert "LeftAnti" not in text and "LeftSemi" not in text and "SortMergeJoin" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("words", [1, 2, 1 << 20])
def test_unknown_keys_of_any_type_and_size(spark, monkeypatch, words):
    monkeypatch.setattr(keys, "WORDS", words)  # keys beyond the bitmap take the other way
    r = random.Random(3)
    children = [(r.choice([None, -5, 0, 3, 63, 64, 100, 700, 2**40, 2**40 + 1, 9]), r.choice([None, "a", "b", "é", ""])) for _ in range(800)]
    parents = [(k, s) for k, s in zip([0, 3, 63, 100, 2**40, -5, None, 3], ["a", "", None, "a", "c", "d", "e", "f"])]
    child, parent = spark.createDataFrame(children, "k long, s string"), spark.createDataFrame(parents, "p long, q string")
    small = child.where("abs(k) < 1000").withColumn("k", F.col("k").cast("int"))
    got = found(unknown([(Key("k", child, ("k",)), Key("", parent, ("p",))), (Key("s", child, ("s",)), Key("", parent, ("q",))),
                         (Key("int", small, ("k",)), Key("", parent, ("p",))), (Key("self", parent, ("p",)), Key("", parent, ("p",)))]))
    known_k, known_s = {p for p, _ in parents}, {q for _, q in parents}
    assert got == {"k": sum(k is not None and k not in known_k for k, _ in children),
                   "s": sum(s is not None and s not in known_s for _, s in children),
                   "int": sum(k is not None and abs(k) < 1000 and k not in known_k for k, _ in children)}
    other = spark.createDataFrame([(9,), (64,)], "z int")
    rows = with_known(child, {"in_p": ("k", parent, "p"), "in_z": ("k", other, "z")}).collect()
    assert len(rows) == len(children)
    assert Counter((x["k"], x["in_p"], x["in_z"]) for x in rows) == Counter((k, k is not None and k in known_k, k in (9, 64)) for k, _ in children)


def test_a_dimension_of_ten_million_keys(spark):
    dimension = spark.range(1, 10_000_001).withColumnRenamed("id", "customer_key")
    fact = spark.range(200_000).select((F.col("id") * 97 % 10_000_100).alias("customer_key"))
    wanted = sum(1 for i in range(200_000) if not 1 <= i * 97 % 10_000_100 <= 10_000_000)
    check = unknown([(Key("c", fact, ("customer_key",)), Key("", dimension, ("customer_key",)))])
    assert found(check) == {"c": wanted}
    assert wanted and "Exchange hashpartitioning(customer_key" not in plan(check)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "k int, s string")
    assert found(repeats([Key("k", none, ("k",)), Key("s", none, ("k", "s"))])) == {}
    assert found(unknown([(Key("k", none, ("k",)), Key("", none, ("k",)))])) == {}
    some = spark.createDataFrame([(1, "a"), (None, None)], "k int, s string")
    assert found(unknown([(Key("k", some, ("k",)), Key("", none, ("k",))), (Key("s", some, ("s",)), Key("", none, ("s",)))])) == {"k": 1, "s": 1}
    assert keep_first(none, ["k"]).collect() == []

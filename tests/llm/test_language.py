import random
import zlib

import pytest
from pyspark.sql import functions as F

from attain.llm import langid
from cases import awkward, frame

WORDS = {"en": "the of and that with house water from this have", "de": "der die und das mit haus wasser von dieser haben",
         "fr": "le la et que avec maison eau de cette avoir", "es": "el los y que con casa agua desde esta haber"}


def corpus(n=60):
    rng = random.Random(3)
    rows, langs = [], {}
    for i in range(n * 4):
        lang = list(WORDS)[i % 4]
        langs[i + 100] = lang
        rows.append((i + 100, " ".join(rng.choice(WORDS[lang].split()) for _ in range(rng.randint(5, 40)))))
    return rows, langs


def test_held_out_accuracy(spark):
    rows, langs = corpus()
    docs = frame(spark, rows, langs)
    model = langid.fit(docs.where("doc_id % 4 <> 2 OR doc_id % 8 = 2"))
    assert model.families == (("de", "en"), ("es", "fr"))
    found = langid.identify(docs, model).collect()
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in found) / len(found) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found)


def test_awkward_rows(spark):
    rows, langs = corpus(20)
    model = langid.fit(frame(spark, rows, langs))
    docs = frame(spark, awkward())
    out = langid.identify(docs, model)
    assert out.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score"]
    got = [(r["doc_id"], r["lang_pred"]) for r in out.collect()]
    assert len(got) == len(awkward())
    unknown = {i for i, label in got if label == "und"}
    assert unknown == {1, 2, 3, 10, None}  # the null text without id; the other row without id has words
    assert sum(label == "und" for i, label in got if i is None) == 1
    assert {label for i, label in got if i == 8} <= set(WORDS) and len({label for i, label in got if i == 8}) == 1


def test_no_labels_and_empty_table(spark):
    docs = frame(spark, awkward())
    assert langid.fit(docs) is None
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(docs, None).collect()} == {("und", 0.0)}
    rows, langs = corpus(5)
    assert langid.identify(docs.limit(0), langid.fit(frame(spark, rows, langs))).count() == 0


def test_unlisted_and_single_language(spark):
    model = langid.fit(frame(spark, [(1, "qwe rty uio"), (2, "qwe rty")], {1: "xx", 2: "xx"}))
    assert model.families == (("xx",),)
    assert langid.identify(frame(spark, [(5, "anything")]), model).first()["lang_pred"] == "xx"


def test_copies_do_not_crowd_out_a_language(spark):
    rows, langs = corpus(10)
    rows = [r for r in rows if langs[r[0]] != "fr"] + [(1000 + i, f"le la {'et que avec ' * i}") for i in range(30)]
    langs |= {1000 + i: "fr" for i in range(30)}
    copies = frame(spark, [(5000, "maison eau")], {5000: "fr"}).crossJoin(spark.range(20_000).select()).select("doc_id", "text", "lang")
    docs = frame(spark, rows, langs).select("doc_id", "text", "lang").union(copies)
    got = {r["lang"]: r["n"] for r in langid.sample(docs, "text", "lang", 300).groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert got["fr"] == 31


def test_every_label_is_learned(spark):
    labels = [f"q{i:03}" for i in range(110)]
    rows = [(i, f"{chr(97 + i % 26) * 3}{chr(97 + i // 26) * 4} {chr(97 + i // 26)}{chr(97 + i % 26) * 2}") for i in range(110)]
    train = rows + [(200 + i, t + " " + t) for i, t in rows]
    langs = {i: labels[i % 200] for i, _ in train}
    model = langid.fit(frame(spark, train, langs))
    assert sorted(x for f in model.families for x in f) == labels and max(map(len, model.families)) == langid.BLOCK
    found = {r["doc_id"]: r["lang_pred"] for r in langid.identify(frame(spark, rows), model).collect()}
    assert sum(found[i] == labels[i] for i in range(110)) > 100


def test_only_the_text_decides(spark):
    rows, langs = corpus(10)
    model = langid.fit(frame(spark, rows, langs))
    text = rows[0][1]
    got = langid.identify(frame(spark, [(1, text), (2, text), (None, text)], {1: "fr", 2: "zz"}), model).select("lang_pred", "score").distinct()
    assert got.count() == 1


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_query(spark, folder):
    from attain.llm.queries import op1_language

    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op1_language(spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and docs[r["doc_id"]]["lang"]]
    assert sum(docs[r["doc_id"]]["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97

import __spark_entry__ as entry
import pytest

import corpus_pipeline
from attain.llm.common import Stages
from cases import awkward, frame, prose
from test_pairs import expected_leaks, expected_lines, near
from test_packing import reference_ids


@pytest.fixture
def folder(spark, tmp_path):
    bench = [(1, prose(600, 30)), (2, prose(601, 25))]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(i, prose(i, 60)) for i in range(40)] + [(40 + i, prose(i, 60).replace("alpha", "beta", 1)) for i in range(10)]
    rows += [(60 + i, prose(700 + i, 30) + " " + bench[i % 2][1] + "\n" + prose(800, 40)) for i in range(6)]
    rows += [(None if i is None else i + 500, t) for i, t in awkward() if i is None or i not in (6, 7)]
    langs = {i: "xx" for i in range(0, 40, 2)}
    docs = frame(spark, [(None if i is None else i + 1000, t) for i, t in rows], {k + 1000: v for k, v in langs.items()})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_stages_by_brute_force(spark, folder):
    """Each stage against plain Python on what the stage before it kept."""
    stages = Stages(spark, "test")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, [(r["doc_id"], r["text"]) for r in docs.collect()]
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stages.write(stage(spark, docs, folder))
        rows = docs.collect()
        if name == "packing":
            got = {}
            for r in rows:
                got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
            want = {}
            for i, t in before:
                want[i] = want.get(i, 0) + len(reference_ids(t)) + 1
            assert got == want
            continue
        assert docs.columns == columns
        if name == "language":
            want = [(i, t) for i, t in before if t and any(c.isalpha() for c in t)]
        elif name == "line_dedup":
            want = expected_lines(before, 1, 20)
            was = {str((i, t)) for i, t in before}
            want = [(i, t) for i, t in want if t.strip() or str((i, t)) in was]
        elif name == "near_dedup":
            sets, label = near(before)
            groups = {}
            for k, (i, _) in enumerate(before):
                if sets[k] and i is not None:
                    groups[label[k]] = min(i, groups.get(label[k], i))
            want = [(i, t) for k, (i, t) in enumerate(before) if not sets[k] or i == groups.get(label[k]) or i is None]
        else:
            leaks = {d for d, _ in expected_leaks(before, bench)}
            want = [(i, t) for i, t in before if i not in leaks or i is None]
        before = [(r["doc_id"], r["text"]) for r in rows]
        assert sorted(before, key=str) == sorted(want, key=str), name
        assert all(r["n_chars"] == len(r["text"]) for r in rows if r["text"] is not None)


def test_run_and_registration(spark, folder):
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    names = [n.split("_")[0] for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)]
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and max(r["offset"] + r["length"] for r in rows) <= 2048
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_texts_without_letter_go_without_labels_too(spark):
    docs = frame(spark, awkward())
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.language(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(i, t) for i, t in awkward() if t and any(c.isalpha() for c in t)], key=str)


def test_empty_documents(spark, tmp_path, folder):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(str(tmp_path / "none" / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0

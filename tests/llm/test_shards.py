import pytest
from pyspark.sql import functions as F

from attain.llm import sharding
from cases import awkward, frame, prose

def size():
    return F.octet_length(F.coalesce("text", F.lit(""))) + 1


def totals(rows, shards):
    sizes = [0] * shards
    for r in rows:
        sizes[r["shard"]] += r["size"]
    return sizes


def check(rows, n, shards):
    assert len(rows) == n
    for s in range(shards):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    sizes = totals(rows, shards)
    most = max((r["size"] for r in rows), default=0)
    ideal = sum(sizes) / shards
    done = 0
    for s in range(shards - 1):  # each border is as near to its place as one row allows
        done += sizes[s]
        assert abs(done - ideal * (s + 1)) <= most
    order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    keys = [r["doc_id"] for r in order]
    assert [k for k in keys if k is not None] == sorted(k for k in keys if k is not None)


@pytest.mark.parametrize("task_bytes", [64 << 20, 2000])
def test_random_rows(spark, task_bytes):
    rows = [(i * 37 % 1000, prose(i, 1 + i % 50)) for i in range(1000)]
    out = sharding.shard(frame(spark, rows), "doc_id", size(), 16, task_bytes=task_bytes).collect()
    check(out, 1000, 16)


def test_awkward_rows(spark):
    docs = frame(spark, awkward())
    out = sharding.shard(docs, "doc_id", size(), 4)
    assert out.columns == [c for c in docs.columns if c not in ("size", "slot")] + ["size", "shard", "slot"]
    check(out.collect(), len(awkward()), 4)


def test_one_key_and_repeated_rows_are_split(spark):
    out = sharding.shard(frame(spark, [(5, "same")] * 400), "doc_id", size(), 16).collect()
    check(out, 400, 16)
    assert max(totals(out, 16)) - min(totals(out, 16)) <= 2 * 5


def test_few_rows_and_empty_table(spark):
    check(sharding.shard(frame(spark, [(1, "a")]), "doc_id", size(), 16).collect(), 1, 16)
    out = sharding.shard(frame(spark, []).limit(0), "doc_id", size(), 16)
    assert out.count() == 0 and out.columns[-3:] == ["size", "shard", "slot"]


def test_wide_keys(spark):
    top = (1 << 63) - 2
    rows = [(k, "text") for k in (-top, -5, 0, 1, 2, 3, top, top - 1, None, None)]
    check(sharding.shard(frame(spark, rows), "doc_id", size(), 3).collect(), len(rows), 3)

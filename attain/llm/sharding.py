"""Histogram sort: splitters found by exact byte counts below probes, then one exchange into balanced shards."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attain.llm.common import Stages

#: Probes of one counting round over all open splitters.
PROBES = 512
LOWEST = -(1 << 63)


def place(keys: np.ndarray, ties: np.ndarray, probes: list[tuple[int, int]]) -> np.ndarray:
    """For each (key, tie) the number of sorted probes that are not above it."""
    probe_keys = np.array([k for k, _ in probes], np.int64)
    probe_ties = np.array([t for _, t in probes], np.int64)
    low, high = np.searchsorted(probe_keys, keys, "left"), np.searchsorted(probe_keys, keys, "right")
    out = low.astype(np.int64)
    same = np.flatnonzero(low < high)
    for start in np.unique(low[same]):
        rows = same[low[same] == start]
        out[rows] = start + np.searchsorted(probe_ties[start:high[rows[0]]], ties[rows], "right")
    return out


def histogram(keyed: DataFrame, probes: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Exact rows and bytes below each probe; every task sums its rows before the counts meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for b in batches:
            at = place(b.column("k").to_numpy(), b.column("t").to_numpy(), probes)
            np.add.at(rows, at, 1)
            np.add.at(size, at, b.column("size").to_numpy())
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(rows[used]), pa.array(size[used])], names=["bin", "rows", "size"])

    found = (keyed.mapInArrow(run, "bin long, rows long, size long").groupBy("bin")
             .agg(F.sum("rows").alias("rows"), F.sum("size").alias("size")).collect())
    rows, size = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for r in found:
        rows[r["bin"]], size[r["bin"]] = r["rows"], r["size"]
    return np.cumsum(rows)[:-1], np.cumsum(size)[:-1]


def between(low: tuple[int, int], high: tuple[int, int], n: int) -> list[tuple[int, int]]:
    """Up to n probes strictly between two (key, tie) pairs, evenly in the keys or, inside one key, in the ties."""
    (k0, t0), (k1, t1) = low, high
    if k1 - k0 > 1:
        return sorted({(k0 + (k1 - k0) * i // (n + 1), 0) for i in range(1, n + 1)} - {low, high} - {(k0, 0)})
    if k1 == k0 + 1:  # the rest of key k0, and key k1 up to t1
        t1 = 1 << 62 if t1 == 0 else t1
        return sorted({(k0, t0 + (t1 - t0) * i // (n + 1)) for i in range(1, n + 1)} - {low} | ({(k1, 0)} - {high}))
    return sorted({(k0, t0 + (t1 - t0) * i // (n + 1)) for i in range(1, n + 1)} - {low, high})


def splitters(keyed: DataFrame, targets: list[tuple[float, float]]) -> dict[tuple[int, int], tuple[int, int]]:
    """For each (bytes below, tolerance) a probe that meets it or comes nearest; with exact (rows, bytes) below.

    Every round counts, in one pass, the rows and bytes below new probes inside the open intervals.
    """
    ends = keyed.agg(F.min("k").alias("a"), F.max("k").alias("b"), F.count("*").alias("n"), F.sum("size").alias("s")).first()
    known = {(ends["a"], 0): (0, 0), (ends["b"] + 1, 0): (ends["n"], ends["s"])}
    while True:
        order = sorted(known)
        sizes = [known[p][1] for p in order]
        open_ = set()
        for target, slack in targets:
            at = bisect_right(sizes, target) - 1
            low = order[max(at, 0)]
            high = order[min(at + 1, len(order) - 1)]
            if min(abs(known[low][1] - target), abs(known[high][1] - target)) > slack and known[high][0] - known[low][0] > 1:
                open_.add((low, high))
        probes = sorted({p for low, high in open_ for p in between(low, high, max(2, PROBES // len(open_)))} - set(known))
        if not probes:
            break
        rows, size = histogram(keyed, probes)
        known.update({p: (int(r), int(s)) for p, r, s in zip(probes, rows, size)})
    order = sorted(known)
    sizes = np.array([known[p][1] for p in order])
    return {p: known[p] for p in sorted({order[int(np.argmin(np.abs(sizes - target)))] for target, _ in targets})}


def shard(df: DataFrame, key: str, size: Column, shards: int = 16, *, tolerance: float = 1e-4,
          task_bytes: int = 64 << 20) -> DataFrame:
    """Rows sorted by key into shards of near equal bytes: the input's columns with size, shard and slot.

    key is an integer column (null sorts first), size the bytes of a row (null counts as 0). Rows of one key are
    told apart by their place in the input, so repeated rows never weigh a shard down; the input must give the
    same row order when read again, as a table does. slot numbers the rows of a shard from 0 without gaps, in key
    order. Splitters meet tolerance (a share of a shard) or are as near as a single row allows. Inside a shard
    finer splitters bound what one task sorts to about task_bytes. Input columns named size, shard or slot are
    replaced. An empty table gives no rows.
    """
    spark = df.sparkSession
    rest = [c for c in df.columns if c not in ("size", "shard", "slot")]
    rows = (df.select(F.struct(*rest).alias("row"), F.coalesce(F.col(key).cast("long"), F.lit(LOWEST)).alias("k"),
                      F.coalesce(size.cast("long"), F.lit(0)).alias("size"))
            .withColumn("t", F.monotonically_increasing_id()))
    stages = Stages(spark, "shard")
    keyed = stages.write(rows.select("k", "t", "size"))
    whole = keyed.agg(F.count("*").alias("n"), F.sum("size").alias("s")).first()
    if not whole["n"]:
        return rows.select("row.*", "size", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    one = whole["s"] / shards
    parts = max(1, int(-(-one // task_bytes)))
    outer = [(one * i, tolerance * one) for i in range(1, shards)]
    inner = [(one * (i + j / parts), 0.25 * one / parts) for i in range(shards) for j in range(1, parts)]
    cuts = splitters(keyed, outer + inner)
    stages.drop(keyed)
    edges = [p for p in cuts]
    sizes = np.array([cuts[p][1] for p in edges])
    below = [0, *(cuts[p][0] for p in edges)]
    bounds = [int(np.argmin(np.abs(sizes - target))) + 1 for target, _ in outer]  # the first bin of shards 1, 2, ...
    shard_of = np.searchsorted(bounds, np.arange(len(edges) + 1), "right")
    first = np.array([below[([0, *bounds])[s]] for s in shard_of])
    base = np.array(below) - first

    @F.pandas_udf("bin int, shard int, base long")
    def assign(k: pd.Series, t: pd.Series) -> pd.DataFrame:
        at = place(k.to_numpy(), t.to_numpy(), edges)
        return pd.DataFrame({"bin": at.astype(np.int32), "shard": shard_of[at].astype(np.int32), "base": base[at]})

    order = Window.partitionBy("to.bin").orderBy("k", "t")
    return (rows.withColumn("to", assign("k", "t"))
            .select("row", "size", "to", (F.row_number().over(order) - 1).cast("long").alias("n"))
            .select("row.*", "size", F.col("to.shard").alias("shard"), (F.col("n") + F.col("to.base")).alias("slot")))

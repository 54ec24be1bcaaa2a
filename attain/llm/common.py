"""What the operators share: written stage tables, connected components, words and shingles as arrays."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
#: Bytes of text that are turned into arrays at once inside a task.
CHUNK_BYTES = 1 << 19
#: Rows of 64 bits in a filter table: its size is fixed (1 MB), whatever the data.
FILTER_ROWS = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a session that names none, as in tests, gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="attain-llm-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


class Stages:
    """Tables that a run writes to the shared folder: they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
        self.count = 0

    def write(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.stage_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a stage that no later result reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df.stage_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame, stages: Stages) -> DataFrame:
    """(id, component) of every id in edges (a, b): component is the smallest id that is reachable.

    Alternating large-star and small-star rounds; every round is written, and the edges never grow
    beyond the given ones. Null ends and loops are ignored; no edges give no rows.
    """
    spark = stages.spark
    pairs = stages.write(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                         .where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct())
    mark = None
    while True:
        now = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now["n"] == 0 or (now["n"], now["h"]) == mark:
            break
        mark = (now["n"], now["h"])
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        newer = stages.write(small)
        stages.drop(pairs)
        pairs = newer
    return (pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
            if mark else spark.createDataFrame([], "id long, component long"))


def shift_left(value: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", value, bits.cast("int"))


def filter_rows(keys: DataFrame) -> DataFrame:
    """A bitmap of the 64-bit keys: at most FILTER_ROWS rows (slot, bits). It may hold more, never fewer."""
    return (keys.groupBy(F.pmod(F.shiftright("key", 6), F.lit(FILTER_ROWS)).alias("slot"))
            .agg(F.bit_or(shift_left(F.lit(1).cast("long"), F.pmod("key", F.lit(64)))).alias("bits")))


def maybe_in(df: DataFrame, key: str, rows: DataFrame) -> DataFrame:
    """df with a flag __in, false only where the key is certainly not among those of rows."""
    bit = shift_left(F.lit(1).cast("long"), F.pmod(key, F.lit(64))).bitwiseAND(F.coalesce("bits", F.lit(0).cast("long"))) != 0
    return (df.join(F.broadcast(rows), F.pmod(F.shiftright(key, 6), F.lit(FILTER_ROWS)) == F.col("slot"), "left")
            .withColumn("__in", bit).drop("slot", "bits"))


def without(df: DataFrame, id_col: str, lost: DataFrame) -> DataFrame:
    """The rows of df whose integer id is not among lost (id). Only rows that may be lost are shuffled."""
    ids = lost.select(F.col("id").alias("lost_id")).where("lost_id IS NOT NULL")
    key = F.xxhash64(F.col(id_col).cast("long"))
    rows = maybe_in(df.select(F.struct(*df.columns).alias("row"), F.col(id_col).cast("long").alias("id"), key.alias("hit")), "hit",
                    filter_rows(ids.select(F.xxhash64(F.col("lost_id").cast("long")).alias("key"))))
    rest = rows.where("__in").join(ids, F.col("id") == F.col("lost_id"), "left_anti")
    return rows.where("NOT __in").select("row.*").unionByName(rest.select("row.*"))


# ---------------------------------------------------------------- in tasks

try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # no glibc
    _trim = None


def give_back() -> None:
    """Return freed memory to the system at the end of a task: workers live on, and other stages need the room."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


_rng = np.random.default_rng(20240817)
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
SHINGLE_CODES = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads all bits."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        _powers[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b, np.uint64))]) for b in (_BASE, _INVERSE)]
    return _powers[0], _powers[1]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES):
    """(first row, row offsets, bytes) of slices of whole texts, about limit bytes each. Null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, offsets[row:end + 1] - offsets[row], data[offsets[row]:offsets[end]]
        row = end


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of lower-cased texts, and for each text the number of words before it."""
    white = WHITE[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    before, after = np.empty_like(white), np.empty_like(white)
    before[0], before[1:] = True, white[:-1]
    after[-1], after[:-1] = True, white[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = True
    after[edges - 1] = True
    starts = np.flatnonzero(~white & before)
    ends = np.flatnonzero(~white & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_codes(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit code of each span of lower-cased bytes."""
    up, down = powers(len(lower) + 1)
    total = np.zeros(len(lower) + 1, np.uint64)
    part = BYTE_CODES.take(lower)
    part *= up[:len(lower)]
    np.cumsum(part, out=total[1:])
    return mix((total.take(ends) - total.take(starts)) * down.take(starts) + (ends - starts).astype(np.uint64))


def word_codes(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit code of every lower-cased word, and for each text the number of words before it."""
    lower = LOWER[data]
    starts, ends, first = words(offsets, lower)
    return span_codes(lower, starts, ends), first


def shingles(codes: np.ndarray, first: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all runs of size words inside each text, in order; a shorter text has its whole sequence as one.

    Returns the codes and for each text the number of codes before it. A text without words has none.
    """
    n = np.diff(first)
    counts = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    out_first = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(out_first[-1]) - np.repeat(out_first[:-1], counts) + np.repeat(first[:-1], counts)
    have = np.repeat(np.minimum(n, size), counts)
    value = have.astype(np.uint64) * SHINGLE_CODES[-1]
    last = max(len(codes) - 1, 0)
    for k in range(size):
        part = codes[np.minimum(at + k, last)] * SHINGLE_CODES[k] if len(codes) else value
        value = value + (part if have.size and have.min() >= size else np.where(have > k, part, np.uint64(0)))
    return mix(value), out_first

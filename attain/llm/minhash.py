"""Near duplicates by b-bit MinHash: bands of minima give candidates, packed low bits estimate their similarity,
full shingle sets confirm links, and links are closed to components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attain.llm.common import SHINGLE_WORDS, Stages, chunks, components, filter_rows, give_back, maybe_in, mix, shingles, word_codes

#: 32 bands of 4 minima: a pair of similarity 0.75 shares a band but for a chance of 5e-6.
BANDS, BAND_ROWS = 32, 4
HASHES = BANDS * BAND_ROWS
#: Low bits of each minimum that the packed signature keeps.
BITS = 4
#: The estimate of a pair has a standard deviation of about 0.041; a pair this much below the threshold is not checked.
MARGIN = 0.17
#: Members of a bucket that are compared in one step; larger buckets are dealt out in chunks.
CHUNK = 512
#: Members of a bucket whose pairs are listed; in larger ones the full sets come to the block.
FEW = 32

_rng = np.random.default_rng(31)
_FACTORS = (_rng.integers(1, 2**63, HASHES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_SHIFTS = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
_BAND_FACTORS = (_rng.integers(1, 2**63, (BANDS, BAND_ROWS), dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_ONES = np.uint64(0x1111111111111111)


def minima(codes: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over shingle codes."""
    out = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(codes), 2048):
        part = codes[i:i + 2048]
        np.minimum(out, (_FACTORS[:, None] * part[None, :] + _SHIFTS[:, None]).min(axis=1), out=out)
    return mix(out)


def packed(low: np.ndarray) -> bytes:
    """The low BITS bits of the minima, two to a byte."""
    few = (low & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return (few[0::2] << 4 | few[1::2]).tobytes()


def band_keys(low: np.ndarray) -> np.ndarray:
    parts = (low.reshape(BANDS, BAND_ROWS) * _BAND_FACTORS).sum(axis=1, dtype=np.uint64)
    return mix(parts + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def set_key(own: np.ndarray) -> int:
    """A 64-bit key of a set of shingle codes."""
    return int(mix(mix(own + np.uint64(len(own))).sum(dtype=np.uint64)[None]).view(np.int64)[0])


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of rows of packed signatures (as 64-bit words): the share of equal minima, corrected for low bits
    that agree by chance."""
    x = a ^ b
    x = x | (x >> np.uint64(1))
    x = x | (x >> np.uint64(2))
    differ = np.bitwise_count(x & _ONES).sum(axis=-1, dtype=np.int64)
    chance = 1.0 / (1 << BITS)
    return ((HASHES - differ) / HASHES - chance) / (1 - chance)


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """id, number of shingles, key of the shingle set, packed signature and band keys of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, data in chunks(batch.column("text")):
                codes, first = shingles(*word_codes(offsets, data), size)
                n = len(first) - 1
                count, keys = np.zeros(n, np.int64), np.zeros(n, np.int64)
                signs, bands = [None] * n, [None] * n
                for i in range(n):
                    own = np.unique(codes[first[i]:first[i + 1]])
                    if len(own):
                        low = minima(own)
                        count[i] = len(own)
                        keys[i] = set_key(own)
                        signs[i], bands[i] = packed(low), band_keys(low)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(row, n), pa.array(count), pa.array(keys, mask=count == 0),
                    pa.array(signs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["id", "n", "rid", "sign", "bands"])
        give_back()

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "id long, n long, rid long, sign binary, bands array<long>"))


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, size: int, wanted: DataFrame) -> DataFrame:
    """(rid, codes) of the documents whose (id, rid) is wanted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, data in chunks(batch.column("text")):
                codes, first = shingles(*word_codes(offsets, data), size)
                found = [np.unique(codes[first[i]:first[i + 1]]) for i in range(len(first) - 1)]
                asked = batch.column("rid").slice(row, len(found)).to_pylist()
                right = [(r, f.tobytes()) for r, f in zip(asked, found) if len(f) and set_key(f) == r]  # an id may repeat
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in right], pa.int64()), pa.array([f for _, f in right], pa.binary())],
                                                 names=["rid", "codes"])

    some = maybe_in(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                                F.xxhash64(F.col(id_col).cast("long")).alias("hit")), "hit",
                    filter_rows(wanted.select(F.xxhash64("id").alias("key")))).where("__in").select("id", "text")
    ids = wanted.withColumnRenamed("id", "wanted_id")
    return (some.join(ids, F.col("id").eqNullSafe(F.col("wanted_id"))).select("rid", "text")
            .mapInArrow(run, "rid long, codes binary"))


def may_link(label: np.ndarray, n: np.ndarray, signs: np.ndarray, percent: int) -> np.ndarray:
    """Estimates of all pairs of a block; 0 where the pair has one label or cannot be near enough."""
    m = len(label)
    weight = np.empty((m, m))
    for i in range(0, m, 64):
        weight[i:i + 64] = estimate(signs[i:i + 64, None, :], signs[None, :, :])
    weight[weight < percent / 100 - MARGIN] = 0
    weight[100 * np.minimum.outer(n, n) < percent * np.maximum.outer(n, n)] = 0
    weight[label[:, None] == label[None, :]] = 0
    return weight


def spanning_pairs(weight: np.ndarray) -> list[tuple[int, int]]:
    """A maximum spanning forest over the estimates of a block."""
    m = len(weight)
    edges, best, link = [], np.zeros(m), np.zeros(m, np.int64)
    todo = np.ones(m, bool)
    for _ in range(m):
        at = int(np.argmax(np.where(todo, best, -1)))
        if best[at] > 0:
            edges.append((int(link[at]), at))
        todo[at] = False
        better = todo & (weight[at] > best)
        best[better], link[better] = weight[at][better], at
    return edges


def linked_pairs(weight: np.ndarray, n: np.ndarray, codes: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links of a block, confirmed on full sets, that join what is not joined yet; all pairs with a weight are tried."""
    joined, out = np.arange(len(codes)), []
    for i in range(len(codes)):
        others = np.flatnonzero(weight[i, :i])
        others = others[joined[others] != joined[i]]
        if not len(others):
            continue
        found = np.concatenate([codes[j] for j in others])
        at = np.minimum(np.searchsorted(codes[i], found), len(codes[i]) - 1)
        starts = np.concatenate([[0], np.cumsum(n[others])[:-1]])
        both = np.add.reduceat(codes[i][at] == found, starts, dtype=np.int64)
        for j in others[100 * both >= percent * (n[i] + n[others] - both)]:
            if joined[i] != joined[j]:
                out.append((i, int(j)))
                joined[joined == joined[j]] = joined[i]
    return out


def in_blocks(members: DataFrame, work) -> DataFrame:
    """(a, b): the pairs that work (arrays of a block by column name -> pairs of places) finds in each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def pairs(t: pa.Table) -> pa.RecordBatch:
            block, rid = t.column("block").to_numpy(), t.column("rid").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]])
            found = set()
            for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if e - s > 1:
                    found.update((int(rid[s + i]), int(rid[s + j])) for i, j in work(t.slice(s, e - s)))
            found = list({(min(p), max(p)) for p in found})
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.int64()), pa.array([p[1] for p in found], pa.int64())], names=["a", "b"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            block = t.column("block").to_numpy()
            whole = int(np.searchsorted(block, block[-1], "left")) if len(block) else 0
            if whole:
                yield pairs(t.slice(0, whole).combine_chunks())
            rest = t.slice(whole)
        if rest is not None and rest.num_rows:
            yield pairs(rest.combine_chunks())
        give_back()

    return (members.repartition("block").sortWithinPartitions("block")
            .mapInArrow(run, "a long, b long").where("a <> b").distinct())


def columns_of(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    signs = np.frombuffer(b"".join(t.column("sign").to_pylist()), np.uint64).reshape(t.num_rows, -1)
    return t.column("label").to_numpy(), t.column("n").to_numpy(), signs


def first_pairs(members: DataFrame, percent: int) -> DataFrame:
    return in_blocks(members, lambda t: spanning_pairs(may_link(*columns_of(t), percent)))


def all_pairs(members: DataFrame, percent: int) -> DataFrame:
    return in_blocks(members, lambda t: np.argwhere(np.triu(may_link(*columns_of(t), percent))).tolist())


def confirmed_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Links in blocks whose members bring their full sets. A pair that shares several buckets is tried in that with
    the smallest key; where bucket is null, blocks have each pair once."""

    def work(t: pa.Table) -> list[tuple[int, int]]:
        label, n, signs = columns_of(t)
        weight = may_link(label, n, signs, percent)
        bucket = t.column("bucket")[0].as_py()
        if bucket is not None:
            bands = np.array(t.column("bands").to_pylist(), np.int64)
            for i in np.flatnonzero(weight.any(1)):
                others = np.flatnonzero(weight[i])
                shared = np.where(bands[others] == bands[i], bands[others], np.iinfo(np.int64).max).min(1)
                weight[i, others[shared != bucket]] = 0
        codes = [np.frombuffer(c, np.uint64) for c in t.column("codes").to_pylist()]
        return linked_pairs(weight, n, codes, percent)

    return in_blocks(members, work)


def check(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are near enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("codes_a"), batch.column("codes_b")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])
        give_back()

    left = sets.select(F.col("rid").alias("a"), F.col("codes").alias("codes_a"))
    right = sets.select(F.col("rid").alias("b"), F.col("codes").alias("codes_b"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def chunk_of(count: str) -> Column:
    return F.pmod(F.xxhash64("rid"), F.ceil(F.col(count) / CHUNK))


def numbers(count: str) -> Column:
    """0, 1, ... for each chunk of count members."""
    return F.sequence(F.lit(0).cast("long"), F.ceil(F.col(count) / CHUNK) - 1)


def open_blocks(now: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks (block, bucket, rid, label) of what may still link different labels, from all members (bucket, rid, label):
    those of small buckets, and those of large buckets and labels.

    A label of many members stands for them: whoever shares a bucket with it meets all its members once, not
    once for each bucket that they share. All others meet in their buckets, chunk by chunk in large ones.
    """
    large = now.select("rid", "label").distinct().groupBy("label").agg(F.count("*").alias("c")).where(F.col("c") > CHUNK)
    now = now.join(large, "label", "left")
    small = now.where("c IS NULL").select("bucket", "rid", "label")
    mixed = (small.groupBy("bucket").agg(F.count("*").alias("m"), F.min("label").alias("l0"), F.max("label").alias("l1"))
             .where("l0 <> l1").select("bucket", "m"))
    rows = small.join(mixed, "bucket")
    few = rows.where(F.col("m") <= FEW).select(F.col("bucket").alias("block"), "bucket", "rid", "label")
    own = chunk_of("m")
    meets = F.transform(numbers("m"), lambda j: F.xxhash64("bucket", F.least(own, j), F.greatest(own, j)))
    many = rows.where(F.col("m") > FEW).select(F.explode(meets).alias("block"), "bucket", "rid", "label")
    big = now.where("c IS NOT NULL").select("bucket", F.col("label").alias("big"), "c").distinct()
    lesser = big.select("bucket", F.col("big").alias("lesser"), F.col("c").alias("lesser_c"))
    touching = (big.join(lesser, "bucket").where("lesser_c < c OR lesser_c = c AND lesser < big").select("big", "c", "lesser").distinct())
    held = now.where("c IS NOT NULL").select("label", "rid", "c").distinct()
    asks = (small.join(big, "bucket").select("big", "c", "rid", "label").distinct()
            .unionByName(held.drop("c").join(touching, F.col("label") == F.col("lesser")).select("big", "c", "rid", "label")))
    asked = asks.groupBy("big").agg(F.count("*").alias("q"))
    own_q, own_c = chunk_of("q"), chunk_of("c")
    meet = F.transform(numbers("c"), lambda i: F.xxhash64(F.lit("large"), F.col("big"), i, own_q))
    wait = F.transform(numbers("q"), lambda j: F.xxhash64(F.lit("large"), F.col("big"), own_c, j))
    none = F.lit(None).cast("long").alias("bucket")
    return few, (many.unionByName(asks.join(asked, "big").select(F.explode(meet).alias("block"), none, "rid", "label"))
                 .unionByName(held.withColumn("big", F.col("label")).join(asked, "big").select(F.explode(wait).alias("block"), none, "rid", "label")))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, size: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: id_col, n_shingles, component_id, kept.

    Texts are lower-cased (A-Z) and cut into words at white space; a document's set has its distinct runs of size
    words, or its whole sequence if it is shorter. Documents link when 100 * intersection >= percent * union, and
    component_id is the smallest id that links reach. Null, empty and blank texts have no shingle and link with
    nothing. A null id is never the smallest; rows that share an id are one document, kept or dropped together, and a
    group without any id has a null component and is kept. Repeated rows stay in the result. Columns beside
    id and text are ignored. An empty table gives no rows.

    Copies (equal sets) are one candidate. First, in each band bucket, a maximum spanning forest over the estimated
    similarities is checked on full sets. Then all other pairs of a bucket whose members are not yet in one
    component are checked: in small buckets they are listed, in large ones the sets meet in blocks of a bounded number
    of members. So the pairs of a large group are never listed.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "minhash")
    all_docs = stages.write(signatures(docs, id_col, text_col, size))
    least = all_docs.where("rid IS NOT NULL").groupBy("rid").agg(F.min("id").alias("least"))
    least = stages.write(least)
    reps = (all_docs.join(least.withColumnsRenamed({"rid": "least_rid"}), (F.col("rid") == F.col("least_rid")) & F.col("id").eqNullSafe(F.col("least")))
            .select("id", "rid", "n", "sign", "bands"))
    once = reps.select("rid", "bands").dropDuplicates(["rid"])  # rows may repeat, and bit_xor cancels what comes twice
    keys = once.select("rid", F.explode("bands").alias("bucket"))
    buckets = keys.groupBy("bucket").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("rid")).alias("who"), F.bit_xor(F.xxhash64(F.lit(1), "rid")).alias("too")).where("size > 1")
    buckets = stages.write(buckets.groupBy("size", "who", "too").agg(F.min("bucket").alias("bucket")).select("bucket", "size"))
    rows = maybe_in(reps.select("rid", F.explode("bands").alias("band")), "band", filter_rows(buckets.select(F.col("bucket").alias("key"))))
    members = stages.write(rows.where("__in").join(buckets, F.col("band") == F.col("bucket")).select("bucket", "size", "rid").distinct())
    signs = stages.write(reps.select("id", "rid", "n", "sign", "bands").join(members.select("rid").distinct(), "rid", "left_semi").dropDuplicates(["id", "rid"]))
    signed = signs.select("rid", "n", "sign")

    def sets_of(rids: DataFrame) -> DataFrame:
        wanted = signs.select("id", "rid").join(rids, "rid", "left_semi")
        return stages.write(shingle_sets(docs, id_col, text_col, size, wanted).dropDuplicates(["rid"]))

    part = F.when(F.col("size") > CHUNK, chunk_of("size")).otherwise(0)
    blocks = members.select(F.xxhash64("bucket", part).alias("block"), "rid", F.col("rid").alias("label"))
    pairs = stages.write(first_pairs(blocks.join(signed, "rid"), percent))
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct())
    links = stages.write(check(pairs, sets, percent))
    labels = components(links, stages)
    now = stages.write(members.join(labels.withColumnRenamed("id", "rid"), "rid", "left").select("bucket", "rid", F.coalesce("component", "rid").alias("label")))
    few, many = open_blocks(now)
    listed = stages.write(all_pairs(few.join(signed, "rid"), percent).join(pairs, ["a", "b"], "left_anti"))
    many = stages.write(many)
    rids = listed.select(F.explode(F.array("a", "b")).alias("rid")).unionByName(many.select("rid")).distinct()
    sets = sets.unionByName(sets_of(rids.join(sets, "rid", "left_anti")))
    met = many.join(signs.select("rid", "n", "sign", "bands"), "rid").join(sets, "rid")
    links = stages.write(links.unionByName(check(listed, sets, percent)).unionByName(confirmed_pairs(met, percent)))
    labels = components(links, stages)
    of = least.join(labels.withColumnRenamed("id", "rid"), "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    lowest = of.groupBy("component").agg(F.min("least").alias("component_id"))
    of = of.join(lowest, "component").select("rid", "component_id")
    done = all_docs.select("id", "n", "rid").join(of, "rid", "left")
    component = F.when(F.col("rid").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return done.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                       F.col("id").eqNullSafe(component).alias("kept"))

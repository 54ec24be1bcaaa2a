"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted similarity."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attain.llm.common import SHINGLE_WORDS, chunks, give_back, mix, shingles, without, word_codes

#: Bits of a fingerprint that may differ. At similarity 0.75 about 11 of 64 do, with a standard deviation of 3.
RADIUS = 23
BLOCKS = 8
#: If all 8 blocks differed in 3 bits or more, 24 bits would: so some block is within 2.
BLOCK_RADIUS = RADIUS // BLOCKS
#: Words of the benchmark items that tasks hold at a time; larger benchmarks are taken in turns.
HELD_WORDS = 2_000_000
#: Window starts of a document that are fingerprinted at once.
STARTS = 8192
FILTER_BITS = 22


def signs(codes: np.ndarray) -> np.ndarray:
    """Running sums of the signs of the 64 bits of each code, from 0."""
    bits = np.unpackbits(mix(codes).view(np.uint8).reshape(len(codes), 8), axis=1).astype(np.int32) * 2 - 1
    return np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])


def fingerprint(sums: np.ndarray) -> np.ndarray:
    """(n, 8) bytes of the signs of summed bits; every occurrence of a shingle has weighed in once."""
    return np.packbits(sums > 0, axis=1)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two lists of codes: weights are numbers of occurrences."""
    (x, n), (y, m) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(n[i], m[j]).sum())
    return both / (len(a) + len(b) - both)


class Items:
    """Items of one number of shingles, with the Hamming tables of their fingerprints."""

    def __init__(self, numbers: list[int], codes: list[np.ndarray]):
        self.numbers, self.codes = numbers, codes
        self.prints = np.concatenate([fingerprint(signs(c)[-1:]) for c in codes])
        near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :]) <= BLOCK_RADIUS
        self.tables = [near[:, self.prints[:, b]] for b in range(BLOCKS)]  # block value, item

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and items whose fingerprints are within RADIUS: a block in reach, then all bits."""
        mask = np.zeros((len(prints), len(self.codes)), bool)
        for b in range(BLOCKS):
            mask |= self.tables[b][prints[:, b]]
        at, item = np.nonzero(mask)
        apart = np.bitwise_count(prints[at].view(np.uint64)[:, 0] ^ self.prints[item].view(np.uint64)[:, 0])
        return at[apart <= RADIUS], item[apart <= RADIUS]


class Benchmark:
    """A bounded block of items; item numbers index ids."""

    def __init__(self, rows: list[tuple[int | None, str | None]], size: int):
        self.ids, self.size = [r[0] for r in rows], size
        by_length: dict[int, list] = defaultdict(list)
        self.short: dict[int, dict[int, list[int]]] = {}
        for row, offsets, data in chunks(pa.array([r[1] for r in rows], pa.string())):
            codes, first = word_codes(offsets, data)
            own, at = shingles(codes, first, size)
            for i, n in enumerate(np.diff(first)):
                part = own[at[i]:at[i + 1]].copy()
                if n >= size:
                    by_length[len(part)].append((row + i, part))
                elif n:
                    self.short.setdefault(int(n), {}).setdefault(int(part[0]), []).append(row + i)
        self.groups = {n: Items([i for i, _ in found], [c for _, c in found]) for n, found in sorted(by_length.items())}
        every = [c for g in self.groups.values() for c in g.codes]
        self.known = np.unique(np.concatenate(every)) if every else np.zeros(0, np.uint64)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.known >> np.uint64(64 - FILTER_BITS)] = True
        self.longest = max(self.groups, default=0)

    def hits(self, codes: np.ndarray) -> np.ndarray:
        """Places of codes that some item has."""
        at = np.flatnonzero(self.filter[codes >> np.uint64(64 - FILTER_BITS)])
        if not len(at) or not len(self.known):
            return np.zeros(0, np.int64)
        found = np.minimum(np.searchsorted(self.known, codes[at]), len(self.known) - 1)
        return at[self.known[found] == codes[at]]

    def match(self, codes: np.ndarray, hits: np.ndarray, least: float) -> dict[int, tuple[float, int, int]]:
        """Item number -> best (similarity, start, shingles) in a text; windows without a shared shingle are not alike."""
        best: dict[int, tuple[float, int, int]] = {}
        n, reach = len(codes), self.longest
        cuts = np.flatnonzero(np.diff(hits) >= 2 * reach) + 1
        for part in np.split(hits, cuts):
            low, high = max(0, int(part[0]) - reach + 1), min(n, int(part[-1]) + reach)
            for a in range(low, high, STARTS):
                b = min(high, a + STARTS + reach)
                sums = signs(codes[a:b])
                counted = np.concatenate([[0], np.cumsum(np.bincount(hits[(hits >= a) & (hits < b)] - a, minlength=b - a))])
                for length, items in self.groups.items():
                    own = min(length, n)
                    if 100 * own < 75 * length and own / length < least or b - a < own:
                        continue
                    starts = np.flatnonzero(counted[own:] - counted[:-own] > 0)
                    if not len(starts):
                        continue
                    windows, found = items.candidates(fingerprint(sums[starts + own] - sums[starts]))
                    for w, i in zip(windows.tolist(), found.tolist()):
                        s = a + int(starts[w])
                        alike = similarity(codes[s:s + own], items.codes[i])
                        number = items.numbers[i]
                        if alike >= least and (number not in best or (-alike, s) < (-best[number][0], best[number][1])):
                            best[number] = (alike, s, own)
        return best


def find(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", least: float = 0.75, size: int = SHINGLE_WORDS) -> DataFrame:
    """(id_col, item_col, similarity, start_word, n_words): each item that a document has, with its best window.

    Words are lower-cased (A-Z) and cut at white space. A window has as many words as the item (the whole text if that is
    shorter). Similarity is the weighted Jaccard similarity of runs of size words, weights being numbers of
    occurrences. An item shorter than size words must occur as it is. Null, empty and blank texts and items match
    nothing. Repeated documents and items are reported each; rows that are equal in all columns stay. Null ids are
    carried. Other columns are ignored. Empty tables give no rows.

    The benchmark is taken in blocks of a bounded number of words; each block meets all documents in one pass
    without a shuffle.
    """
    weight = F.greatest(F.size(F.split(F.coalesce(item_text_col, F.lit("")), r"\s+")), F.lit(1))
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text"))
    total = benchmark.agg(F.sum(weight).alias("n")).first()["n"] or 0
    turns = max(1, -(-total // HELD_WORDS))
    out = None
    for turn in range(turns):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(turns)) == turn).collect()
        held = Benchmark(sorted(((r["item"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")), size)
        found = scan(docs, held, id_col, text_col, item_col, least)
        out = found if out is None else out.unionByName(found)
    return out


def scan(docs: DataFrame, held: Benchmark, id_col: str, text_col: str, item_col: str, least: float) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench: Benchmark = sent.value
        for batch in batches:
            rows, found = [], []
            for row, offsets, data in chunks(batch.column("text")):
                words, first = word_codes(offsets, data)
                codes, at = shingles(words, first, bench.size)
                hits = bench.hits(codes)
                doc = np.searchsorted(at, hits, "right") - 1
                for i in np.unique(doc):
                    own = codes[at[i]:at[i + 1]]
                    for number, (alike, start, length) in bench.match(own, hits[doc == i] - at[i], least).items():
                        n = min(int(first[i + 1] - first[i]), length + bench.size - 1)
                        rows.append(row + int(i)), found.append((number, alike, start, n))
                for n, wanted in bench.short.items():
                    codes, at = shingles(words, first, n)
                    for p in np.flatnonzero(np.isin(codes, np.array(list(wanted), np.uint64))):
                        i = int(np.searchsorted(at, p, "right") - 1)
                        if first[i + 1] - first[i] >= n and not any(r == row + i and f[0] in wanted[int(codes[p])] for r, f in zip(rows, found)):
                            for number in wanted[int(codes[p])]:
                                rows.append(row + i), found.append((number, 1.0, int(p - at[i]), n))
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(rows, pa.int64())), pa.array([bench.ids[f[0]] for f in found], pa.int64()),
                pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.int64()),
                pa.array([f[3] for f in found], pa.int64())], names=["id", "item", "similarity", "start_word", "n_words"])
        give_back()

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, item long, similarity double, start_word long, n_words long")
            .withColumnsRenamed({"id": id_col, "item": item_col}))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that have no item of the benchmark (see find). Rows that share an id go or stay together;
    rows with a null id stay."""
    return without(docs, id_col, find(docs, benchmark, id_col=id_col, **options).select(F.col(id_col).cast("long").alias("id")))

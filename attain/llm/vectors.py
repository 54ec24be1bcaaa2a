"""Near-duplicate vectors by an inverted multi-index: codebooks on both halves, nearest cells first, exact cosines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attain.llm.common import Stages, components

#: Vectors that the codebooks of one dimension are fitted on, at most.
SAMPLE = 20_000
#: Different vectors of a cell that the number of codes aims at, and most codes of a half.
CELL_FILL, MOST_CODES = 32, 256
#: Rows of either side in one comparison; larger cells are cut into chunks that all meet.
CHUNK = 1024


@dataclass(frozen=True)
class Index:
    """Codes of the two halves and the number of cells that a query visits."""
    first: np.ndarray
    second: np.ndarray
    visits: int

    @property
    def codes(self) -> int:
        return len(self.first)


def fit_codes(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    codes = points[rng.choice(len(points), k, replace=len(points) < k)].copy()
    for _ in range(rounds):
        near = np.argmin(distances(points, codes), axis=1)
        for j in range(k):
            own = points[near == j]
            codes[j] = own.mean(0) if len(own) else points[rng.integers(len(points))]
    return codes


def distances(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (points * points).sum(1)[:, None] - 2 * points @ codes.T + (codes * codes).sum(1)[None, :]


def traverse(index: Index, units: np.ndarray, visits: int) -> np.ndarray:
    """The visits nearest cells of each vector, nearest first: multi-sequence order of the sums of the distances.

    A cell of the i-th nearest first code and the j-th nearest second code comes after i * j - 1 others at least, so
    only the pairs with i * j <= visits can be among the first.
    """
    half = len(index.first[0])
    k = index.codes
    d1, d2 = distances(units[:, :half], index.first), distances(units[:, half:], index.second)
    o1, o2 = np.argsort(d1, 1, kind="stable"), np.argsort(d2, 1, kind="stable")
    pairs = np.array([(i, j) for i in range(min(k, visits)) for j in range(min(k, visits // (i + 1)))])
    out = np.empty((len(units), min(visits, k * k, len(pairs))), np.int32)
    for s in range(0, len(units), 512):
        part = slice(s, s + 512)
        own = np.arange(len(units[part]))[:, None]
        a, b = o1[part][:, pairs[:, 0]], o2[part][:, pairs[:, 1]]
        order = np.argsort(d1[part][own, a] + d2[part][own, b], 1, kind="stable")[:, :out.shape[1]]
        out[part] = a[own, order] * k + b[own, order]
    return out


def fit_index(sample: np.ndarray, total: int, cosine: float, recall: float) -> Index:
    """Codebooks from sampled unit vectors, and the visits that find neighbours just at the threshold.

    The visits are counted on neighbours made at exactly the given cosine in random directions: closer ones and
    pairs that either vector may find are found more often.
    """
    rng = np.random.default_rng(5)
    dim = sample.shape[1]
    half = max(1, dim // 2)
    k = int(min(MOST_CODES, max(2, round(np.sqrt(total / CELL_FILL)))))
    index = Index(fit_codes(sample[:, :half], k, rng), fit_codes(sample[:, half:], k, rng) if dim > 1 else np.zeros((k, 0)), 1)
    probe = sample[:2000]
    noise = rng.standard_normal(probe.shape)
    noise -= (noise * probe).sum(1, keepdims=True) * probe
    noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
    other = cosine * probe + np.sqrt(max(0.0, 1 - cosine * cosine)) * noise
    visits, most = 4, k * k
    while visits < most:
        seen, cell = traverse(index, probe, visits), traverse(index, other, 1)
        if (seen == cell).any(1).mean() >= recall:
            break
        visits = min(most, visits * 3 // 2)
    return Index(index.first, index.second, visits)


def units_of(vectors: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)
    # scaled by the largest component first, so that squares neither overflow nor vanish
    raw = raw / np.abs(raw).max(1, keepdims=True)
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def encode(rows: DataFrame) -> DataFrame:
    """(id, label, dim, vec): vec has the components as doubles; null where the row can link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec, dim = [], []
            for value, label in zip(batch.column("vector").to_pylist(), batch.column("label").to_pylist()):
                usable = label is not None and value and None not in value
                own = np.array(value, np.float64) if usable else None
                usable = usable and bool(np.isfinite(own).all()) and bool(own.any())
                vec.append((own + 0.0).tobytes() if usable else None)
                dim.append(len(own) if usable else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(dim, pa.int32()), pa.array(vec, pa.binary())],
                                             names=["id", "label", "dim", "vec"])

    return rows.mapInArrow(run, f"id long, label {rows.schema['label'].dataType.simpleString()}, dim int, vec binary")


def locate(distinct: DataFrame, indexes: dict[int, Index]) -> DataFrame:
    """Adds the cell of each vector and the cells that it visits (32-bit numbers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, vecs = batch.column("dim").to_numpy(), batch.column("vec").to_pylist()
            cell, visits = np.zeros(len(vecs), np.int32), [None] * len(vecs)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                found = traverse(indexes[int(dim)], units_of([vecs[i] for i in rows]), indexes[int(dim)].visits)
                cell[rows] = found[:, 0]
                for i, own in zip(rows, found):
                    visits[i] = own.tolist()
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("place"), batch.column("vec"), batch.column("times"), pa.array(cell),
                                              pa.array(visits, pa.list_(pa.int32()))], names=["rid", "place", "vec", "times", "cell", "visits"])

    place = F.xxhash64("label", "dim")
    return (distinct.select("rid", place.alias("place"), "dim", "vec", "times")
            .mapInArrow(run, "rid long, place long, vec binary, times long, cell int, visits array<int>"))


def joined(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component numbers of the rows and columns of a bipartite graph (-1: without link), by spreading the smallest."""
    rows = np.where(linked.any(1), np.arange(len(linked)), -1)
    big = len(linked)
    while True:
        columns = np.where(linked, np.where(rows < 0, big, rows)[:, None], big).min(0)
        new = np.where(rows < 0, -1, np.minimum(rows, np.where(linked, columns[None, :], big).min(1)))
        if (new == rows).all():
            return rows, np.where(columns == big, -1, columns)
        rows = new


def compare(blocks: DataFrame, cosine: float) -> DataFrame:
    """(rid, n, other): numbers of linked vectors (other null), and edges to a vector of the same component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def work(t: pa.Table) -> pa.RecordBatch:
            key, side = t.column("block").to_numpy(), t.column("side").to_numpy()
            rid, times, cell = (t.column(c).to_numpy() for c in ("rid", "times", "cell"))
            vec, visits = t.column("vec").to_pylist(), t.column("visits").to_pylist()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
            ids, numbers, others = [], [], []
            for s, e in zip(cuts[:-1], cuts[1:]):
                q, x = s + np.flatnonzero(side[s:e] == 0), s + np.flatnonzero(side[s:e] == 1)
                if not len(q) or not len(x):
                    continue
                near = units_of([vec[i] for i in q]) @ units_of([vec[i] for i in x]).T >= cosine
                near &= rid[q][:, None] != rid[x][None, :]
                if not near.any():
                    continue
                q, x, near = q[near.any(1)], x[near.any(0)], near[near.any(1)][:, near.any(0)]
                ids += rid[q].tolist()
                numbers += (near @ times[x]).tolist()
                cells, which = np.unique(cell[q], return_inverse=True)
                blind = np.array([[c not in own for c in cells.tolist()] for own in ({*visits[i]} for i in x)])  # x does not find q itself
                back = times[q] @ (near & blind[:, which].T)
                ids += rid[x].tolist()
                numbers += back.tolist()
                others += [None] * (len(q) + len(x))
                a, b = joined(near)
                ids += rid[q].tolist() + rid[x].tolist()
                others += rid[q][a].tolist() + rid[q][b].tolist()
                numbers += [0] * (len(q) + len(x))
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int64()), pa.array(others, pa.int64())], names=["rid", "n", "other"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            key = t.column("block").to_numpy()
            whole = int(np.searchsorted(key, key[-1], "left")) if len(key) else 0
            if whole:
                yield work(t.slice(0, whole).combine_chunks())
            rest = t.slice(whole)
        if rest is not None and rest.num_rows:
            yield work(rest.combine_chunks())

    return blocks.repartition("block").sortWithinPartitions("block").mapInArrow(run, "rid long, n long, other long")


def near_vectors(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.93,
                 recall: float = 0.98) -> DataFrame:
    """One row per vector: id_col, n_links, component_id, kept.

    Vectors of one label and dimension link when their cosine (doubles) is found and at least the threshold.
    n_links counts other rows, equal vectors included; component_id is the smallest id that links reach. Vectors that are
    null, empty or zero, hold null or non-finite components, or have no label link with nothing. Null ids are
    never the smallest. Repeated rows are equal vectors; other columns are ignored; an empty table gives no rows.

    Equal vectors are searched once. Codebooks are fitted on at most SAMPLE different vectors of each dimension;
    every vector is indexed and is a query. A query visits its nearest cells until recall is met for neighbours
    at the threshold. Cells with many vectors are compared chunk by chunk.
    """
    spark = rows.sparkSession
    stages = Stages(spark, "vectors")
    every = stages.write(encode(rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label"))))
    usable = every.where("vec IS NOT NULL")
    distinct = stages.write(usable.groupBy("label", "dim", "vec").agg(F.count("*").alias("times"), F.min("id").alias("least"))
                            .withColumn("rid", F.monotonically_increasing_id()))
    sizes = {r["dim"]: r["n"] for r in distinct.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    indexes = {}
    for dim, n in sizes.items():
        share = F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, SAMPLE / n)))
        sample = distinct.where((F.col("dim") == dim) & share).select("vec").orderBy(F.xxhash64("vec")).limit(SAMPLE).collect()
        sample = sample or distinct.where(F.col("dim") == dim).select("vec").limit(1).collect()
        indexes[dim] = fit_index(units_of([bytes(r["vec"]) for r in sample]), n, cosine, recall)
    found = stages.write(locate(distinct, indexes))
    asked = found.select("rid", "place", "vec", "times", "cell", "visits", F.explode("visits").alias("at"))
    held = found.groupBy("place", F.col("cell").alias("at")).agg(F.count("*").alias("x"))
    load = found.select("place", F.explode("visits").alias("at")).groupBy("place", "at").agg(F.count("*").alias("q")).join(held, ["place", "at"])
    load = load.select("place", "at", F.ceil(F.col("x") / CHUNK).alias("nx"), F.ceil(F.col("q") / CHUNK).alias("nq"))
    load = stages.write(load)

    def blocks(side: DataFrame, number: int, own: str, other: str) -> DataFrame:
        part = F.pmod(F.xxhash64("rid"), F.col(own))
        pair = (lambda o: F.xxhash64("place", "at", part, o)) if number else (lambda o: F.xxhash64("place", "at", o, part))
        keys = F.transform(F.sequence(F.lit(0).cast("long"), F.col(other) - 1), pair)
        return side.join(load, ["place", "at"]).select(F.explode(keys).alias("block"), F.lit(number).alias("side"), "rid", "times", "cell", "vec", "visits")

    index_side = found.select("rid", "place", "vec", "times", "cell", "visits", F.col("cell").alias("at"))
    both = blocks(asked, 0, "nq", "nx").unionByName(blocks(index_side, 1, "nx", "nq"))
    made = stages.write(compare(both, cosine))
    linked = components(made.where("other IS NOT NULL").select(F.col("rid").alias("a"), F.col("other").alias("b")), stages)
    numbers = made.where("n > 0").groupBy("rid").agg(F.sum("n").alias("n"))
    of = (distinct.join(linked.withColumnRenamed("id", "rid"), "rid", "left").join(numbers, "rid", "left")
          .select("label", "dim", "vec", "least", F.coalesce("component", "rid").alias("component"),
                  (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links")))
    lowest = of.groupBy("component").agg(F.min("least").alias("component_id"))
    of = of.join(lowest, "component").select("label", "dim", "vec", "n_links", "component_id")
    done = every.join(of, ["label", "dim", "vec"], "left")
    component = F.when(F.col("vec").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return done.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                       F.col("id").eqNullSafe(component).alias("kept"))

"""Hashed maximum-entropy language model with a class-factored softmax over n-gram and skip features.

Words have leaves: a frequent word its own, the others share leaves by their ending. A leaf lies in a class. The model
is P(word | before) = P(class | before) P(leaf | class, before) P(word | leaf). The first two are softmaxes over
hashed features of the words before; the last is the add-half share of the word among its leaf's training tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attain.llm.common import CHUNK_BYTES, LOWER, SHINGLE_CODES, WHITE, Stages, chunks, span_codes, word_codes, words

CLASSES = 32
#: Leaves of each class; the first OWN of all leaves belong to single words.
LEAVES = 32
OWN = 768
#: Hash buckets of the features of the class softmax and of the leaf softmax.
CLASS_ROWS, LEAF_ROWS = 1 << 12, 1 << 14
#: Words whose counts every task holds; counts of the rest are joined.
HELD = 100_000
#: Learning rate of AdaGrad, tokens of a gradient step.
RATE, STEP = 0.25, 4096
#: Bytes of text whose words are counted at once.
COUNT_BYTES = 1 << 23
END = b"\n"  # no word has white space
TOTAL = CLASSES * LEAVES


@dataclass(frozen=True)
class Vocabulary:
    """counts: of the most frequent words; own: their leaves; sizes: tokens and words of each leaf."""
    counts: dict[bytes, int]
    own: dict[bytes, int]
    tokens: np.ndarray
    words: np.ndarray

    @property
    def train_tokens(self) -> int:
        return int(self.tokens.sum())

    @property
    def known(self) -> int:
        return int(self.words.sum())


def shared_leaf(word: bytes) -> int:
    """The leaf of a word that has none of its own, by its last three bytes."""
    return OWN + (int.from_bytes(word[-3:], "big") * 0x9E3779B1 >> 7) % (TOTAL - OWN)


def place(leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class and place in the class: neighbours in frequency go to different classes."""
    return leaf % CLASSES, leaf // CLASSES


def distinct_words(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of lower-cased texts, and for each word its number among them."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    packed = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(lower[~WHITE[lower]])])
    coded = packed.dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy()


def count_words(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, n) of lower-cased words; every task sums its own before they meet. Each text ends with END."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def out():
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()

        for _, offsets, data in (part for batch in batches for part in chunks(batch.column("text"), COUNT_BYTES)):
            lower = LOWER[data]
            names, index = distinct_words(lower, *words(offsets, lower)[:2])
            for w, n in zip(names.tolist(), np.bincount(index, minlength=len(names)).tolist(), strict=True):
                held[w] = held.get(w, 0) + n
            held[END] = held.get(END, 0) + len(offsets) - 1
            if len(held) > 300_000:
                yield from out()
        if held:
            yield from out()

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Reads the at most HELD most frequent words and the leaf totals from (word, n)."""
    level = F.floor(F.log2(F.col("n")) * 16)
    levels = sorted(((r["level"], r["words"]) for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()), reverse=True)
    cut, seen = None, 0
    for lev, many in levels:
        if seen + many > HELD:
            break
        cut, seen = lev, seen + many
    top = counts.where(level >= cut).collect() if cut is not None else []
    held = {bytes(r["word"]): r["n"] for r in top}
    order = sorted(held, key=lambda w: (-held[w], w))
    own = {w: i for i, w in enumerate(([END] if END in held else []) + [w for w in order if w != END][:OWN - 1])}

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, different = np.zeros(TOTAL, np.int64), np.zeros(TOTAL, np.int64)
        for batch in batches:
            asked = batch.column("word").to_pylist()
            leaf = np.array([own[w] if w in own else shared_leaf(w) for w in asked], np.int64)
            np.add.at(n, leaf, batch.column("n").to_numpy())
            np.add.at(different, leaf, 1)
        used = np.flatnonzero(different)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used]), pa.array(different[used])], names=["leaf", "n", "words"])

    tokens, different = np.zeros(TOTAL, np.int64), np.zeros(TOTAL, np.int64)
    for r in counts.mapInArrow(leaves, "leaf long, n long, words long").groupBy("leaf").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).collect():
        tokens[r["leaf"]], different[r["leaf"]] = r["n"], r["words"]
    return Vocabulary(held, own, tokens, different)


class Weights:
    """Rows of class scores and of leaf scores by hashed feature, beside the scores of the leaf shares alone."""

    def __init__(self, vocab: Vocabulary, class_rows: np.ndarray | None = None, leaf_rows: np.ndarray | None = None):
        share = np.log(vocab.tokens + 0.5 * (vocab.words + 1)).reshape(LEAVES, CLASSES).T  # class, place
        self.class_bias = np.log(np.exp(share).sum(1)).astype(np.float32)
        self.leaf_bias = (share - self.class_bias[:, None]).astype(np.float32)
        self.class_rows = np.zeros((CLASS_ROWS, CLASSES), np.float32) if class_rows is None else class_rows
        self.leaf_rows = np.zeros((LEAF_ROWS, LEAVES), np.float32) if leaf_rows is None else leaf_rows


def features(leaf: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(features, tokens) codes: the word before, the two before, and the words two and three before (skips)."""
    n = len(leaf)
    at = np.arange(n)
    start = np.repeat(first[:-1], np.diff(first))
    back = [np.where(at - k >= start, leaf.take(np.maximum(at - k, 0)), TOTAL).astype(np.uint64) + np.uint64(1) for k in (1, 2, 3)]
    return np.stack([back[0] * SHINGLE_CODES[1], back[0] * SHINGLE_CODES[2] + back[1] * SHINGLE_CODES[3],
                     back[1] * SHINGLE_CODES[4], back[2] * SHINGLE_CODES[5]])


def class_index(codes: np.ndarray) -> np.ndarray:
    return (codes * SHINGLE_CODES[20] >> np.uint64(64 - 12)).astype(np.int64)


def leaf_index(codes: np.ndarray, cls: np.ndarray) -> np.ndarray:
    return ((codes + (cls.astype(np.uint64) + np.uint64(1)) * SHINGLE_CODES[21]) * SHINGLE_CODES[22] >> np.uint64(64 - 14)).astype(np.int64)


def weights_of(rows: np.ndarray, index: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights (tokens, outcomes) from the summed rows of each token's features, and their sums: a softmax before it is divided."""
    score = rows.take(index[0], axis=0)
    for k in range(1, len(index)):
        score += rows.take(index[k], axis=0)
    score += bias
    np.minimum(score, 60, out=score)  # far above any learned score; keeps exp finite
    np.exp(score, out=score)
    return score, score @ np.ones(score.shape[1], np.float32)


def softmax(rows: np.ndarray, index: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Probabilities (tokens, outcomes)."""
    out, total = weights_of(rows, index, bias)
    out /= total[:, None]
    return out


def errors(rows: np.ndarray, index: np.ndarray, bias: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The right outcome as 1, less the probabilities of all outcomes."""
    out = softmax(rows, index, bias)
    out *= -1
    out[np.arange(len(right)), right] += 1
    return out


def chances(rows: np.ndarray, index: np.ndarray, bias: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The probabilities of the right outcomes."""
    out, total = weights_of(rows, index, bias)
    return out[np.arange(len(right)), right] / total


def segment_sums(values: np.ndarray, at: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of the rows values[at], by adding neighbours pairwise until one row of each run is left."""
    out, runs = np.empty((len(starts), values.shape[1]), values.dtype), np.arange(len(starts))
    while len(runs):
        one = sizes == 1
        out[runs[one]] = values.take(at.take(starts[one]), axis=0)
        runs, starts, sizes = runs[~one], starts[~one], sizes[~one]
        half = sizes >> 1
        begin = np.cumsum(half) - half
        left = np.repeat(starts - 2 * begin, half) + 2 * np.arange(half.sum())
        halved = values.take(at.take(left), axis=0)
        halved += values.take(at.take(left + 1), axis=0)
        odd = np.flatnonzero(sizes & 1)
        halved[begin[odd]] += values.take(at.take(starts[odd] + sizes[odd] - 1), axis=0)
        values, at, starts, sizes = halved, np.arange(len(halved)), begin, half
    return out


def step(rows: np.ndarray, squares: np.ndarray, index: np.ndarray, gradient: np.ndarray) -> None:
    """One AdaGrad step: the gradient of each row is the sum over the tokens and features that use it."""
    flat = index.ravel().astype(np.uint16)  # at most 2^16 rows, for a radix sort
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    used = flat[starts].astype(np.int64)
    token = np.tile(np.arange(index.shape[1]), len(index)).take(order)
    summed = segment_sums(gradient, token, starts, np.diff(np.concatenate([starts, [len(flat)]])))
    square = squares.take(used, axis=0)
    square += summed * summed
    squares[used] = square
    square += 1e-3
    np.sqrt(square, out=square)
    summed *= RATE
    summed /= square
    summed += rows.take(used, axis=0)
    rows[used] = summed


def leaves_of(column: pa.Array, own_codes: np.ndarray, own_leaves: np.ndarray,
              limit: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """First row, leaves of all tokens (ends included) and offsets of whole texts, about limit bytes at a time, and
    their lower-cased bytes with the starts and ends of their words."""
    for row, offsets, data in chunks(column, limit):
        lower = LOWER[data]
        starts, ends, first = words(offsets, lower)
        codes = span_codes(lower, starts, ends)
        size = ends - starts
        leaf = lower.take(ends - 1).astype(np.uint64)
        for k in (1, 2):
            leaf += np.where(size > k, lower.take(np.maximum(ends - 1 - k, 0)), 0).astype(np.uint64) << np.uint64(8 * k)
        leaf = OWN + (leaf * np.uint64(0x9E3779B1) >> np.uint64(7)).astype(np.int64) % (TOTAL - OWN)
        if len(own_codes) and len(codes):
            at = np.minimum(np.searchsorted(own_codes, codes), len(own_codes) - 1)
            hit = own_codes[at] == codes
            leaf[hit] = own_leaves[at[hit]]
        yield row, np.insert(leaf, first[1:], own_leaves[-1]), first + np.arange(len(first)), (lower, starts, ends)


def own_tables(vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes of the words with leaves of their own and the leaves; the last leaf is that of END."""
    named = [w for w in vocab.own if w != END]
    data = np.frombuffer(b"".join(named), np.uint8)
    codes, _ = word_codes(np.cumsum([0, *map(len, named)]), data)
    order = np.argsort(codes)
    end = vocab.own.get(END, shared_leaf(END))
    return codes[order], np.array([*(vocab.own[named[i]] for i in order), end], np.int64)


def train(docs: DataFrame, text_col: str, vocab: Vocabulary, rounds: int = 1) -> Weights:
    """Distributed gradient updates: in a round each task runs over its documents from the weights of the round
    before, and the changes of all tasks are averaged, each row over the tasks that used it."""
    spark = docs.sparkSession
    weights = Weights(vocab)
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((vocab, weights.class_rows, weights.leaf_rows))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocab, class_rows, leaf_rows = sent.value
            w = Weights(vocab, class_rows.copy(), leaf_rows.copy())
            squares, own_words = (np.zeros_like(w.class_rows), np.zeros_like(w.leaf_rows)), own_tables(vocab)
            for leaf, first in ((x, y) for b in batches for _, x, y, _ in leaves_of(b.column("text"), *own_words, CHUNK_BYTES)):
                codes = features(leaf, first)
                cls, inner = place(leaf)
                for i in range(0, len(leaf), STEP):
                    part = slice(i, i + STEP)
                    at, c = class_index(codes[:, part]), cls[part]
                    step(w.class_rows, squares[0], at, errors(w.class_rows, at, w.class_bias, c))
                    at = leaf_index(codes[:, part], c)
                    step(w.leaf_rows, squares[1], at, errors(w.leaf_rows, at, w.leaf_bias[c], inner[part]))
            for kind, new, old, seen in ((0, w.class_rows, class_rows, squares[0]), (1, w.leaf_rows, leaf_rows, squares[1])):
                used = np.flatnonzero(seen.any(1))
                for i in range(0, len(used), 1024):
                    rows = used[i:i + 1024]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(rows + kind * CLASS_ROWS), pa.array([x.tobytes() for x in new[rows] - old[rows]], pa.binary())], names=["row", "change"])

        def mean(group: pa.Table) -> pa.Table:
            row = group.column("row").to_numpy()
            change = np.frombuffer(b"".join(group.column("change").to_pylist()), np.float32).reshape(len(row), -1)
            order = np.argsort(row, kind="stable")
            cuts = np.flatnonzero(np.concatenate([[True], np.diff(row[order]) > 0]))
            summed = np.add.reduceat(change[order], cuts, axis=0) / np.diff(np.concatenate([cuts, [len(row)]]))[:, None]
            return pa.table({"row": row[order][cuts], "change": pa.array([x.astype(np.float32).tobytes() for x in summed], pa.binary())})

        changes = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "row long, change binary")
        # a row comes once from each task that used it; 16 rows are averaged together
        averaged = changes.groupBy((F.col("row") / 16).cast("long").alias("part")).applyInArrow(mean, "row long, change binary")
        class_rows, leaf_rows = weights.class_rows.copy(), weights.leaf_rows.copy()
        for r in averaged.collect():
            change = np.frombuffer(r["change"], np.float32)
            if r["row"] < CLASS_ROWS:
                class_rows[r["row"]] += change
            else:
                leaf_rows[r["row"] - CLASS_ROWS] += change
        sent.unpersist()
        weights = Weights(vocab, class_rows, leaf_rows)
    return weights


def fit(docs: DataFrame, *, text_col: str = "text", rounds: int = 1, stages: Stages | None = None) -> tuple[DataFrame, Vocabulary, Weights]:
    """Counts (a written table), vocabulary and weights from all tokens of the documents."""
    stages = stages or Stages(docs.sparkSession, "lm")
    counts = stages.write(count_words(docs, text_col))
    vocab = vocabulary(counts)
    return counts, vocab, train(docs, text_col, vocab, rounds)


def score(docs: DataFrame, model: tuple[DataFrame, Vocabulary, Weights], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are lower-cased (A-Z) words and one end; null texts count as empty. base_score and score are sums of
    log10 probabilities of the add-half word shares and of the model. Repeated rows stay, other columns are
    ignored, an empty table gives no rows; a model of no documents gives every token the same probability.
    """
    counts, vocab, weights = model
    spark = docs.sparkSession
    stages = Stages(spark, "score")
    sent = spark.sparkContext.broadcast((vocab, weights.class_rows, weights.leaf_rows))
    n_all, known = vocab.train_tokens, vocab.known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, class_rows, leaf_rows = sent.value
        w = Weights(vocab, class_rows, leaf_rows)
        held, below, own_words = vocab.counts, np.log10(vocab.tokens + 0.5 * (vocab.words + 1)), own_tables(vocab)
        for batch, (begin, leaf, first, spans) in ((b, x) for b in batches for x in leaves_of(b.column("text"), *own_words, CHUNK_BYTES)):
            codes = features(leaf, first)
            cls, inner = place(leaf)
            logs = np.empty(len(leaf))
            for i in range(0, len(leaf), STEP):
                part = slice(i, i + STEP)
                c = cls[part]
                p = chances(w.class_rows, class_index(codes[:, part]), w.class_bias, c)
                q = chances(w.leaf_rows, leaf_index(codes[:, part], c), w.leaf_bias[c], inner[part])
                logs[part] = np.log10(np.maximum(p.astype(float), 1e-38)) + np.log10(np.maximum(q.astype(float), 1e-38))
            logs -= below[leaf]
            names, index = distinct_words(*spans)
            names = np.append(names, END)
            index = np.insert(index, first[1:] - np.arange(1, len(first)), len(names) - 1)  # the end of each text
            found = np.fromiter(map(held.get, names.tolist(), repeat(0)), np.int64, len(names))
            held_log, unknown = np.where(found > 0, np.log10(found + 0.5), 0.0).take(index), (found == 0).take(index)
            n_tokens = np.diff(first)
            asked, times = np.unique(np.repeat(np.arange(len(n_tokens)) * len(names), n_tokens)[unknown] + index[unknown], return_counts=True)
            cuts = np.searchsorted(asked, np.arange(len(first)) * len(names))
            rare = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(names.take(asked % len(names)), pa.binary()), pa.array(times)], names=["word", "times"]))
            yield pa.RecordBatch.from_arrays([
                batch.column("id").slice(begin, len(n_tokens)), pa.array(n_tokens),
                pa.array(n_tokens - np.add.reduceat(unknown, first[:-1], dtype=np.int64)),
                pa.array(np.add.reduceat(held_log, first[:-1])), pa.array(np.add.reduceat(logs, first[:-1])), rare],
                names=["id", "n_tokens", "n_held", "held_log", "model_log", "rare"])

    id_type = docs.schema[id_col].dataType.simpleString()
    made = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {id_type}, n_tokens long, n_held long, held_log double, model_log double, rare array<struct<word: binary, times: long>>"))
    made = stages.write(made.withColumn("row", F.monotonically_increasing_id()))
    # counts of the words that tasks do not hold: tasks have summed the rows of one word and document
    asked = made.select("row", F.inline("rare"))
    joined = asked.join(counts, "word", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    rest = joined.groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("times"))).alias("more"),
                                     F.sum(F.col("times") * F.log10(F.col("c") + 0.5)).alias("rare_log"))
    both = made.drop("rare").join(rest, "row", "left")
    word_log = F.col("held_log") + F.coalesce("rare_log", F.lit(0.0))
    return both.select(F.col("id").alias(id_col), "n_tokens", (F.col("n_held") + F.coalesce("more", F.lit(0))).alias("n_known"),
                       F.lit(n_all).cast("long").alias("train_tokens"),
                       (word_log - F.col("n_tokens") * F.lit(float(np.log10(n_all + 0.5 * (known + 1))))).alias("base_score"),
                       (word_log + F.col("model_log")).alias("score"))

"""Alignment of two tokenizers over whole texts, as an associative fragment monoid.

Both tokenizers cover the same bytes. Where a token of each ends, a group closes. A chunk (a byte range of a text) gives a
fragment: an open prefix up to the first common end, closed groups, and an open suffix after the last one. Two fragments
compose by joining the suffix of the left to the prefix of the right, and the order of composition does not matter, so
chunks of a very long text are tokenised by different tasks and composed in a tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attain.llm.common import Stages, give_back
from attain.llm.tokens import Library, byte_alphabet, encoder, library

#: Characters of a chunk, chunks that one composition takes, and bytes that are aligned at once inside a task.
CHUNK_CHARS, FAN, BATCH_BYTES = 1 << 16, 16, 1 << 19
#: Id pairs whose counts every task holds (16 bytes each); counts of all others are joined.
HELD_PAIRS = 1 << 19


class Vocabulary:
    """What the tokens of a tokenizer stand for: bytes, their number, and decimal ids ready to be joined."""

    def __init__(self, lib: Library):
        if lib.path.endswith(".json"):
            byte = byte_alphabet()
            vocab = lib.model.get_vocab(with_added_tokens=True)
            added = {t.content for t in lib.model.get_added_tokens_decoder().values()}
            size = max(vocab.values()) + 1
            self.bytes = [b""] * size
            for token, i in vocab.items():
                self.bytes[i] = token.encode() if token in added else bytes(byte[c] for c in token)
        else:
            m = lib.model
            size = m.vocab_size()
            self.bytes = [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()
                          for i in range(size)]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.size = size

    def names(self, inside: bytes, last: bytes) -> np.ndarray:
        """Decimal ids with a separator behind them: inside a group first, then those that end one."""
        out = np.empty(2 * self.size, object)
        out[:] = [b"%d%s" % (i, sep) for sep in (inside, last) for i in range(self.size)]
        return out


@dataclass
class Pair:
    """Both tokenizers of an alignment, loaded once in each worker."""

    a: Library
    b: Library

    def __post_init__(self):
        self.va, self.vb = Vocabulary(self.a), Vocabulary(self.b)
        self.encode_a = encoder(self.a.path)
        self.names = np.concatenate([self.va.names(b",", b"|"), self.vb.names(b",", b";")])


_pairs: dict[tuple[str, str], Pair] = {}


def pair(path_a: str, path_b: str) -> Pair:
    if (path_a, path_b) not in _pairs:
        _pairs[path_a, path_b] = Pair(library(path_a, special=False), library(path_b, special=False))
    return _pairs[path_a, path_b]


@dataclass
class Run:
    """Tokens of one byte range: ids of both sides and the bytes at which each side starts."""

    a: np.ndarray
    b: np.ndarray
    a_lo: int
    b_lo: int


@dataclass
class Fragment:
    """An open prefix and suffix; without a common end (closed is False) all tokens are in the prefix."""

    closed: bool
    head: Run
    tail: Run | None


@dataclass
class Groups:
    """Closed groups of a fragment: their number, links, decimal ids, and id pairs with their links."""

    n_groups: int
    n_links: int
    text: bytes
    pair_a: np.ndarray
    pair_b: np.ndarray
    pair_n: np.ndarray


def align(runs: list[Run], two: Pair) -> list[tuple[Fragment, Groups]]:
    """Fragments and closed groups of runs that have nothing to do with each other, found together.

    Where a side starts, a token of it has ended before; so starts count among the places that may be common.
    """
    if not runs:
        return []
    base, bases, shifts = 0, [], []
    ends_a, ends_b, starts_a, starts_b = [], [], [], []
    for run in runs:
        low = min(run.a_lo, run.b_lo)
        starts_a.append(run.a_lo - low + base), starts_b.append(run.b_lo - low + base)
        ends_a.append(np.cumsum(two.va.lengths[run.a]) + starts_a[-1])
        ends_b.append(np.cumsum(two.vb.lengths[run.b]) + starts_b[-1])
        bases.append(base), shifts.append(low - base)
        base = max(starts_a[-1], starts_b[-1], *ends_a[-1][-1:].tolist(), *ends_b[-1][-1:].tolist()) + 1
    first_a = np.concatenate([[0], np.cumsum([len(x) for x in ends_a])])
    first_b = np.concatenate([[0], np.cumsum([len(x) for x in ends_b])])
    ids_a, ids_b = (np.concatenate([getattr(r, s) for r in runs]).astype(np.int64) for s in "ab")
    ends_a, ends_b = np.concatenate(ends_a), np.concatenate(ends_b)
    # one flag for every byte: where a token of a side ends, and where a side is at a border (its starts included)
    end_a, end_b, both, border = (np.zeros(base, bool) for _ in range(4))
    end_a[ends_a], end_b[ends_b] = True, True
    both[:] = end_b
    both[starts_b] = True
    border[:] = end_a
    border[starts_a] = True
    both &= border
    # the start of each run is a border too, so that no run meets the open tokens of its neighbour
    border[:] = both
    border[bases] = True
    borders = np.flatnonzero(border)
    own = np.append(np.searchsorted(borders, bases), len(borders))
    count_a, count_b = np.cumsum(end_a), np.cumsum(end_b)
    # order of all tokens, stretch by stretch between borders: those of a before those of b
    stretch = np.cumsum(border) - border
    until_a = np.concatenate([[0], count_a[borders], [len(ids_a)]])
    until_b = np.concatenate([[0], count_b[borders]])
    names = np.empty(len(ids_a) + len(ids_b), np.int64)
    names[np.arange(len(ids_a)) + until_b[stretch[ends_a]]] = ids_a + both[ends_a] * two.va.size
    names[np.arange(len(ids_b)) + until_a[stretch[ends_b] + 1]] = ids_b + 2 * two.va.size + both[ends_b] * two.vb.size
    # a link for every stretch between neighbouring ends
    ends = np.flatnonzero(end_a | end_b)
    at_a, at_b = count_a[ends] - end_a[ends], count_b[ends] - end_b[ends]
    codes = ids_a[np.minimum(at_a, len(ids_a) - 1)] << 32 | ids_b[np.minimum(at_b, len(ids_b) - 1)] if len(ids_a) and len(ids_b) \
        else np.zeros(len(ends), np.int64)
    out = []
    for k, run in enumerate(runs):
        begin, last = own[k] + (run.a_lo != run.b_lo), own[k + 1] - 1  # borders: first common end, last common end
        if begin > last:
            out.append((Fragment(False, run, None), _no_groups()))
            continue
        a, b = until_a[begin + 1], until_b[begin + 1]
        to_a, to_b = until_a[last + 1], until_b[last + 1]
        end = int(borders[last] + shifts[k])
        head = Run(ids_a[first_a[k]:a], ids_b[first_b[k]:b], run.a_lo, run.b_lo)
        tail = Run(ids_a[to_a:first_a[k + 1]], ids_b[to_b:first_b[k + 1]], end, end)
        text = b"".join(two.names.take(names[a + b:to_a + to_b]).tolist())
        own_codes = codes[slice(*np.searchsorted(ends, borders[[begin, last]], side="right"))]
        code, n = np.unique(own_codes, return_counts=True)
        out.append((Fragment(True, head, tail), Groups(int(last - begin), len(own_codes), text, (code >> 32).astype(np.int32),
                                                       (code & 0xFFFFFFFF).astype(np.int32), n.astype(np.int32))))
    return out


def _no_groups() -> Groups:
    none = np.zeros(0, np.int32)
    return Groups(0, 0, b"", none, none, none)


def compose(left: Fragment, right: Fragment, two: Pair) -> tuple[Fragment, Groups]:
    """Both fragments as one, and the groups that close where they meet."""
    x = left.tail if left.closed else left.head
    seam, groups = align([Run(np.concatenate([x.a, right.head.a]), np.concatenate([x.b, right.head.b]), x.a_lo, x.b_lo)], two)[0]
    if not seam.closed:
        return Fragment(False, seam.head, None), groups
    head = left.head if left.closed else seam.head
    tail = right.tail if right.closed else seam.tail
    return Fragment(True, head, tail), groups


# ---------------------------------------------------------------- texts

def cuts(text: str, lib: Library, chars: int) -> list[int]:
    """Where the chunks of a text start for one tokenizer: at or after every chars characters."""
    out = []
    for at in range(chars, len(text), chars):
        out.append(out[-1] if out and out[-1] >= at else lib.next_cut(text, at))
    return out


def chunks_of(text: str, two: Pair, chars: int) -> Iterator[tuple[str, int, int, int, int]]:
    """(slice, start and end for a, start and end for b, within the slice, in characters) of each chunk, in order."""
    cut_a, cut_b = [0, *cuts(text, two.a, chars), len(text)], [0, *cuts(text, two.b, chars), len(text)]
    for a0, a1, b0, b1 in zip(cut_a, cut_a[1:], cut_b, cut_b[1:]):
        low = min(a0, b0)
        yield text[low:max(a1, b1)], a0 - low, a1 - low, b0 - low, b1 - low


def tokenise(slices: list[str], bounds: np.ndarray, first: list[bool], two: Pair) -> list[Run | None]:
    """The runs of chunks, None where the tokens of a side are not the bytes of the text.

    bounds has start and end for a and for b. The first chunk of a text has the leading space on both sides.
    """
    texts_a = [" " * f + s[a0:a1] for s, f, (a0, a1, _, _) in zip(slices, first, bounds.tolist())]
    texts_b = [s[b0:b1] for s, (_, _, b0, b1) in zip(slices, bounds.tolist())]
    ids_a, ids_b = list(map(two.encode_a, texts_a)), two.b.encode(texts_b, first)
    out = []
    for k, f in enumerate(first):
        a, b = np.array(ids_a[k], np.int64), np.array(ids_b[k], np.int64)
        same = (b"".join(map(two.va.bytes.__getitem__, ids_a[k])) == texts_a[k].encode()
                and b"".join(map(two.vb.bytes.__getitem__, ids_b[k])) == b" " * f + texts_b[k].encode())
        a_lo, b_lo = (len(slices[k][:int(x)].encode()) for x in (bounds[k, 0], bounds[k, 2]))
        out.append(Run(a, b, a_lo, b_lo) if same else None)
    return out


PIECE = ("key long, lo int, ok boolean, n_a long, n_b long, n_groups long, n_links long, sha string, groups binary, "
         "pair_a array<int>, pair_b array<int>, pair_n array<int>")
OPEN = "closed boolean, " + ", ".join(f"{side}_{x} {t}" for side in ("head", "tail") for x, t in
                                      (("a", "array<int>"), ("b", "array<int>"), ("a_lo", "long"), ("b_lo", "long")))
CHUNK = "slice string, a0 int, a1 int, b0 int, b1 int"


def _lists(arrays: list[np.ndarray | None]) -> pa.Array:
    whole = [np.zeros(0, np.int32) if x is None else x.astype(np.int32) for x in arrays]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in whole])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *whole])))


def _piece_columns(keys, lo, ok, sizes, groups: list[Groups], shas, texts) -> dict[str, pa.Array]:
    return {"key": pa.array(keys, pa.int64()), "lo": pa.array(lo, pa.int32()), "ok": pa.array(ok, pa.bool_()),
            "n_a": pa.array([n for n, _ in sizes], pa.int64()), "n_b": pa.array([n for _, n in sizes], pa.int64()),
            "n_groups": pa.array([g.n_groups for g in groups], pa.int64()), "n_links": pa.array([g.n_links for g in groups], pa.int64()),
            "sha": pa.array(shas, pa.string()), "groups": pa.array(texts, pa.binary()),
            "pair_a": _lists([g.pair_a for g in groups]), "pair_b": _lists([g.pair_b for g in groups]), "pair_n": _lists([g.pair_n for g in groups])}


def _open_columns(fragments: list[Fragment | None]) -> dict[str, pa.Array]:
    out = {"closed": pa.array([None if f is None else f.closed for f in fragments], pa.bool_())}
    for side in ("head", "tail"):
        runs = [None if f is None else getattr(f, side) for f in fragments]
        for x in "ab":
            out[f"{side}_{x}"] = _lists([None if r is None else getattr(r, x) for r in runs])
        for x in ("a_lo", "b_lo"):
            out[f"{side}_{x}"] = pa.array([None if r is None else getattr(r, x) for r in runs], pa.int64())
    return out


def _batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _first_pass(batches: Iterator[pa.RecordBatch], paths: tuple[str, str], chars: int) -> Iterator[pa.RecordBatch]:
    """Every text of one chunk as a finished piece; chunks of longer texts as they are, to be spread over tasks."""
    two = pair(*paths)
    base, row = TaskContext.get().partitionId() << 40, 0
    for batch in batches:
        ids, texts = batch.column("id"), batch.column("text")
        at, waiting, size = 0, [], 0

        def flush():
            nonlocal waiting, size
            short = [t for _, t in waiting]
            bounds = np.array([[0, len(t), 0, len(t)] for t in short], np.int64).reshape(-1, 4)
            runs = tokenise(short, bounds, [True] * len(short), two)
            whole = [r for r in runs if r is not None]
            found = iter(align(whole, two))
            groups = [next(found)[1] if r is not None else _no_groups() for r in runs]
            columns = {"id": ids.take(pa.array([i for i, _ in waiting], pa.int64()))}
            columns |= _piece_columns([base + row + i for i, _ in waiting], [0] * len(short), [r is not None for r in runs],
                                      [(0, 0) if r is None else (len(r.a), len(r.b)) for r in runs], groups,
                                      [hashlib.sha256(g.text[:-1]).hexdigest() if g.n_groups else "" for g in groups], [None] * len(short))
            columns |= {"slice": pa.nulls(len(short), pa.string()), **{c: pa.nulls(len(short), pa.int32()) for c in ("a0", "a1", "b0", "b1")}}
            waiting, size = [], 0
            return _batch(columns)

        for at in range(len(texts)):
            text = texts[at].as_py() or ""
            if len(text) > chars:
                for lo, (part, *bounds) in enumerate(chunks_of(text, two, chars)):
                    columns = {"id": ids.slice(at, 1)}
                    columns |= _piece_columns([base + row + at], [lo], [None], [(None, None)], [_no_groups()], [None], [None])
                    columns |= {"slice": pa.array([part]), **{c: pa.array([v], pa.int32()) for c, v in zip(("a0", "a1", "b0", "b1"), bounds)}}
                    yield _batch(columns)
                continue
            if text:
                waiting.append((at, text))
            else:
                columns = {"id": ids.slice(at, 1)}
                columns |= _piece_columns([base + row + at], [0], [False], [(0, 0)], [_no_groups()], [""], [None])
                columns |= {"slice": pa.nulls(1, pa.string()), **{c: pa.nulls(1, pa.int32()) for c in ("a0", "a1", "b0", "b1")}}
                yield _batch(columns)
            size += len(text)
            if size >= BATCH_BYTES:
                yield flush()
        if waiting:
            yield flush()
        row += len(texts)
    give_back()


def _chunk_pass(batches: Iterator[pa.RecordBatch], paths: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    two = pair(*paths)
    for batch in batches:
        for k in range(0, len(batch), 8):
            part = batch.slice(k, 8).to_pylist()
            bounds = np.array([[r["a0"], r["a1"], r["b0"], r["b1"]] for r in part], np.int64)
            runs = tokenise([r["slice"] for r in part], bounds, [r["lo"] == 0 for r in part], two)
            found = iter(align([r for r in runs if r is not None], two))
            done = [next(found) if r is not None else (Fragment(False, Run(np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0), None), _no_groups()) for r in runs]
            columns = _piece_columns([r["key"] for r in part], [r["lo"] for r in part], [r is not None for r in runs],
                                     [(0, 0) if r is None else (len(r.a), len(r.b)) for r in runs], [g for _, g in done],
                                     [None] * len(part), [g.text for _, g in done])
            yield _batch(columns | _open_columns([f for f, _ in done]))
    give_back()


def _fragment(row: dict) -> Fragment:
    runs = [Run(np.array(row[f"{s}_a"], np.int64), np.array(row[f"{s}_b"], np.int64), row[f"{s}_a_lo"], row[f"{s}_b_lo"]) for s in ("head", "tail")
            if row[f"{s}_a_lo"] is not None]
    return Fragment(row["closed"], runs[0], runs[1] if row["closed"] else None)


def _compose_pass(batches: Iterator[pa.RecordBatch], paths: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    """One fragment for the neighbours of a row, and a piece for each seam between them (ok is null in these)."""
    two = pair(*paths)
    for batch in batches:
        for k in range(len(batch)):
            row = batch.slice(k, 1).to_pylist()[0]
            parts = row["parts"]
            whole, at, seams = _fragment(parts[0]), parts[0]["lo"], []
            for part in parts[1:]:
                whole, groups = compose(whole, _fragment(part), two)
                if groups.n_groups:
                    seams.append((part["lo"], groups))
            lo = [at, *[k for k, _ in seams]]
            groups = [_no_groups(), *[g for _, g in seams]]
            columns = _piece_columns([row["key"]] * len(lo), lo, [True] + [None] * len(seams), [(0, 0)] * len(lo), groups, [None] * len(lo),
                                     [g.text for g in groups])
            yield _batch(columns | _open_columns([whole] + [None] * len(seams)))
    give_back()


def _hash_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the groups of each key; rows come in order, and only one of them is held at a time."""
    key, digest, held = None, None, b""
    for batch in batches:
        keys, texts = batch.column("key"), batch.column("groups")
        for i in range(len(keys)):
            now = keys[i].as_py()
            if now != key:
                if key is not None:
                    digest.update(held[:-1])
                    yield _batch({"key": pa.array([key]), "sha": pa.array([digest.hexdigest()])})
                key, digest, held = now, hashlib.sha256(), b""
            text = texts[i].as_py()
            if text:
                digest.update(held)
                held = text
    if key is not None:
        digest.update(held[:-1])
        yield _batch({"key": pa.array([key]), "sha": pa.array([digest.hexdigest()])})


def _count_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each id pair, summed inside the task as long as they are few enough to hold."""
    codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def out():
        return _batch({"a": pa.array((codes >> 32).astype(np.int32)), "b": pa.array((codes & 0xFFFFFFFF).astype(np.int32)), "n": pa.array(counts)})

    for batch in batches:
        a, b, n = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("pair_a", "pair_b", "pair_n"))
        codes, where = np.unique(np.concatenate([codes, a << 32 | b]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([counts, n]), len(codes)).astype(np.int64)
        if len(codes) > 4 * HELD_PAIRS:
            yield out()
            codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(codes):
        yield out()
    give_back()


def _long_documents(first: DataFrame, stages: Stages, paths: tuple[str, str]) -> tuple[DataFrame, DataFrame] | None:
    """(pieces, digests) of the texts of several chunks: aligned chunk by chunk, then composed in a tree."""
    chunks = first.where("slice IS NOT NULL")
    most = chunks.agg(F.max("lo")).first()[0]
    if most is None:
        return None
    spread = chunks.select("key", "lo", "slice", "a0", "a1", "b0", "b1").repartition("key", "lo")
    pieces = [stages.write(spread.mapInArrow(partial(_chunk_pass, paths=paths), f"{PIECE}, {OPEN}"))]
    wrong = pieces[0].where("NOT ok").select("key").distinct()
    parts = pieces[0].join(wrong, "key", "left_anti")
    names = [f.name for f in pieces[0].select("lo", "closed", *[c for c in pieces[0].columns if c[:5] in ("head_", "tail_")]).schema]
    seams, span = [], 1
    while span <= most:
        span *= FAN
        grouped = (parts.groupBy("key", F.floor(F.col("lo") / span).alias("g"))
                   .agg(F.sort_array(F.collect_list(F.struct(*names))).alias("parts")).select("key", "parts"))
        level = stages.write(grouped.mapInArrow(partial(_compose_pass, paths=paths), f"{PIECE}, {OPEN}"))
        parts = level.where("ok")
        seams.append(level.where("ok IS NULL"))
    own = [f.name for f in first.sparkSession.createDataFrame([], PIECE).schema]
    placed = pieces[0].join(wrong, "key", "left_anti").select(*own, (2 * F.col("lo")).alias("place"))
    for level in seams:
        placed = placed.unionByName(level.select(*own, (2 * F.col("lo") - 1).alias("place")))
    placed = stages.write(placed)
    ordered = placed.select("key", "place", "groups").repartition("key").sortWithinPartitions("key", "place").select("key", "groups")
    return placed, ordered.mapInArrow(_hash_pass, "key long, sha string")


def align_documents(docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text",
                    chunk_chars: int = CHUNK_CHARS, held_pairs: int = HELD_PAIRS) -> DataFrame:
    """One row per row of docs: its id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Side a is the space and text by a byte-level tokenizers file, side b the text by a sentencepiece file (which adds that
    space); strings of special tokens are ordinary text. n_best counts the links whose id pair has the highest count of all
    pairs with that id of b over the whole table, ties included; count_sum adds up the counts of all links' pairs.

    Null and empty texts, and texts that a side does not give back byte for byte, have no tokens: zeros and an empty digest.
    Ids are carried as they are, null or repeated; repeated rows count each time; other columns are ignored, whatever their
    names. A text of more than chunk_chars characters is cut into chunks, each side where none of its own tokens can span
    the cut, and the chunks go to different tasks; a run without such a place stays whole. An empty table gives no rows.
    Every task holds the counts of at most held_pairs pairs, the most frequent; those of all others are joined.
    """
    stages = Stages(docs.sparkSession, "align")
    paths = (path_a, path_b)
    id_type = docs.schema[id_col].dataType.simpleString()
    first = stages.write(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                         .mapInArrow(partial(_first_pass, paths=paths, chars=chunk_chars), f"id {id_type}, {PIECE}, {CHUNK}"))
    short = first.where("slice IS NULL")
    sizes = ["n_a", "n_b", "n_groups", "n_links"]
    pairs = ["pair_a", "pair_b", "pair_n"]
    found = _long_documents(first, stages, paths)
    pieces, facts = short.select("key", *pairs), short.select("key", "id", *sizes, "sha")
    none = [F.lit(None).cast(id_type).alias("id")]
    zeros = [F.lit(0).cast("long").alias(c) for c in sizes]
    no_sha = F.lit(None).cast("string").alias("sha")
    if found:
        placed, digests = found
        pieces = pieces.unionByName(placed.select("key", *pairs))
        facts = (facts.unionByName(first.where("slice IS NOT NULL AND lo = 0").select("key", "id", *zeros, no_sha))
                 .unionByName(placed.select("key", *none, *sizes, no_sha))
                 .unionByName(digests.select("key", *none, *zeros, "sha")))

    counted = stages.write(pieces.select(*pairs).mapInArrow(_count_pass, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n")))
    best = counted.groupBy("b").agg(F.max("n").alias("best"))  # at most a row per id of b
    ranked = stages.write(counted.join(F.broadcast(best), "b").select("a", "b", "n", (F.col("n") == F.col("best")).alias("top")))
    held = _held(ranked, held_pairs)
    scored = stages.write(pieces.mapInArrow(partial(_score_pass, held=held), "key long, n_best long, count_sum long, a int, b int, k long"))
    rest = (scored.where("a IS NOT NULL").join(ranked, ["a", "b"])
            .select("key", F.when(F.col("top"), F.col("k")).otherwise(0).alias("n_best"), (F.col("k") * F.col("n")).alias("count_sum")))
    links = scored.where("a IS NULL").select("key", "n_best", "count_sum").unionByName(rest)

    both = (facts.select("*", F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
            .unionByName(links.select("key", *none, *zeros, no_sha, "n_best", "count_sum")))
    out = both.groupBy("key").agg(F.max("id").alias("id"), *[F.sum(c).alias(c) for c in (*sizes, "n_best", "count_sum")], F.max("sha").alias("sha"))
    return out.select(F.col("id").alias(id_col), *sizes, "n_best", "count_sum", F.coalesce("sha", F.lit("")).alias("groups_sha256"))


def _held(ranked: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, counts, whether best) of all pairs above a count that at most `most` pairs reach, sorted by code."""
    classes = {r["c"]: r["rows"] for r in ranked.groupBy(F.floor(F.log2("n") * 8).cast("int").alias("c")).agg(F.count("*").alias("rows")).collect()}
    total, least = 0, None
    for c in sorted(classes, reverse=True):
        total += classes[c]
        if total > most:
            break
        least = c
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    rows = ranked.where(F.floor(F.log2("n") * 8).cast("int") >= least).toArrow()
    a, b, n = (rows[c].to_numpy().astype(np.int64) for c in ("a", "b", "n"))
    order = np.argsort(a << 32 | b)
    return (a << 32 | b)[order], n[order], rows["top"].to_numpy()[order]


def _score_pass(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    """Sums over the pairs that are held, one row for each piece, and the other pairs one by one."""
    codes, counts, top = held
    for batch in batches:
        lists = [batch.column(c) for c in ("pair_a", "pair_b", "pair_n")]
        a, b, k = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists)
        size = np.diff(lists[0].offsets.to_numpy(zero_copy_only=False).astype(np.int64))
        row = np.repeat(np.arange(len(size)), size)
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        code = a << 32 | b
        at = np.minimum(np.searchsorted(codes, code), max(len(codes) - 1, 0))
        known = codes[at] == code if len(codes) else np.zeros(len(code), bool)
        best, total = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        np.add.at(best, row[known], k[known] * top[at[known]])
        np.add.at(total, row[known], k[known] * counts[at[known]])
        other = ~known
        n, m = len(size), int(other.sum())
        blank = np.zeros(m, np.int64)
        ints = [pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(x[other].astype(np.int32))]) for x in (a, b)]
        yield _batch({"key": pa.array(np.concatenate([keys, keys[row[other]]])), "n_best": pa.array(np.concatenate([best, blank])),
                      "count_sum": pa.array(np.concatenate([total, blank])), "a": ints[0], "b": ints[1],
                      "k": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(k[other])])})
    give_back()

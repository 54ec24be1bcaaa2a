"""Vector bin packing of tokenised texts into sequences under limits on tokens, segments and loss-bearing tokens."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attain.llm.common import give_back
from attain.llm.tokens import encoder

SCHEMA = ("id {id}, start long, length long, ids binary, doc_tokens long, loss_tokens long, "
          "sequence_id long, offset long")


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold. Without a number of segments it follows the data: 64, or as many examples as fill a
    sequence where nine tenths of them are no shorter."""

    tokens: int = 2048
    segments: int | None = None
    loss: int = 2048

    def of(self, tokens: np.ndarray) -> np.ndarray:
        short = max(1, int(np.quantile(tokens[tokens > 0], 0.1, method="lower"))) if (tokens > 0).any() else 1
        segments = max(64, -(-self.tokens // short)) if self.segments is None else self.segments
        return np.array([self.tokens, segments, self.loss], float)


class Classes:
    """Open examples by what they demand: equal demands are one class, so a choice costs the number of different ones."""

    def __init__(self, cap: np.ndarray):
        self.cap, self.at, self.members = cap, {}, []
        self.tokens, self.loss, self.demand = np.zeros(64, np.int64), np.zeros(64, np.int64), np.zeros((64, 3))

    def add(self, example: int, tokens: int, loss: int) -> None:
        k = self.at.setdefault((tokens, loss), len(self.members))
        if k == len(self.members):
            if k == len(self.tokens):
                self.tokens, self.loss, self.demand = (np.concatenate([x, np.zeros_like(x)]) for x in (self.tokens, self.loss, self.demand))
            self.members.append([])
            self.tokens[k], self.loss[k] = tokens, loss
            self.demand[k] = np.array([tokens, 1, loss]) / self.cap
        self.members[k].append(example)

    def take(self, k: int) -> int:
        example = self.members[k].pop()
        if not self.members[k]:  # the last class fills the gap
            del self.at[int(self.tokens[k]), int(self.loss[k])]
            last = len(self.members) - 1
            if k < last:
                self.at[int(self.tokens[last]), int(self.loss[last])] = k
                self.members[k], self.tokens[k], self.loss[k], self.demand[k] = self.members[last], self.tokens[last], self.loss[last], self.demand[last]
            self.members.pop()
        return example


def pack_group(tokens: np.ndarray, loss: np.ndarray, limits: Limits) -> np.ndarray:
    """Rows (example, start, length, loss, sequence, offset) of pieces that cover every token of each example once.

    The last loss[i] tokens of example i bear loss. A sequence takes, while anything fits, the example whose
    demand has the largest weighted dot product with what the sequence has left; demands are shares of the
    limits, weighted by the total demand in that dimension. When no whole rest fits, the rest with the best
    product is cut to the room that is left. Examples of equal demand are taken in order.
    """
    cap = limits.of(tokens)
    loss = np.minimum(loss, tokens).astype(np.int64)
    weight = np.array([tokens.sum(), len(tokens), loss.sum()], float) / cap
    weight /= max(weight.max(), 1e-12)
    classes, start = Classes(cap), np.zeros(len(tokens), np.int64)
    for i in np.flatnonzero(tokens > 0)[::-1].tolist():
        classes.add(i, int(tokens[i]), int(loss[i]))
    out, sequence = array("q"), 0
    while classes.members:
        room, offset = cap.copy(), 0
        while (n := len(classes.members)) and room[0] >= 1 and room[1] >= 1:
            score = classes.demand[:n] @ (weight * room / cap)
            fits = (classes.tokens[:n] <= room[0]) & (classes.loss[:n] <= room[2])
            whole = fits.any()
            at = int(np.argmax(np.where(fits, score, -1.0))) if whole else int(np.argmax(score))
            take, bears = rest, rest_loss = int(classes.tokens[at]), int(classes.loss[at])
            if not whole:
                free = take - bears  # tokens before the first that bears loss
                take = int(min(room[0], free + room[2]))
                bears = max(0, take - free)
                if take == 0:
                    break
            i = classes.take(at)
            out.extend((i, int(start[i]), take, bears, sequence, offset))
            offset += take
            room -= (take, 1, bears)
            start[i] += take
            if take < rest:
                classes.add(i, rest - take, rest_loss - bears)
        sequence += 1
    return np.frombuffer(out, np.int64).reshape(-1, 6)


def pack(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None,
         end_id: int | None = 1, limits: Limits = Limits(), group_tokens: int = 512 * 2048) -> DataFrame:
    """Pack whole texts into sequences: one row per piece with its ids (unsigned little-endian 32 bit).

    path names a byte-level tokenizers file. prompt_col, if given, holds text before text_col whose tokens bear
    no loss (instruction data); without it every token bears loss. Null texts count as empty, an empty text has
    only end_id, or no piece if end_id is None. Ids are carried as they are, null or repeated; other columns are
    ignored. Texts of any length are packed whole, cut over as many sequences as they need; equal texts are taken in the order
    of the input. Each task packs its rows in runs of about group_tokens tokens, so nothing is shuffled and memory is
    bounded by a run (or one document); at most one sequence of a run is left short. sequence_id is unique over
    all tasks. An empty table gives no rows.
    """
    schema = SCHEMA.format(id=docs.schema[id_col].dataType.simpleString())
    columns = [F.col(id_col).alias("id"), F.col(text_col).alias("text")]
    columns += [F.col(prompt_col).alias("prompt")] if prompt_col else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, special=True)
        base = TaskContext.get().partitionId() << 40
        ids, found, prompts, waiting, used = [], [], [], 0, 0

        def flush():
            nonlocal waiting, used
            sizes = np.array([len(x) for x in found], np.int64)
            pieces = pack_group(sizes, sizes - np.array(prompts, np.int64), limits)
            if len(pieces):
                which, start, length, loss, sequence, offset = pieces.T
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[i] for i in which.tolist()], id_type), pa.array(start.copy()), pa.array(length.copy()),
                    pa.array([found[i][s:s + n].tobytes() for i, s, n in zip(which.tolist(), start.tolist(), length.tolist())], pa.binary()),
                    pa.array(sizes[which]), pa.array(loss.copy()), pa.array(sequence + (base + used)), pa.array(offset.copy()),
                ], names=["id", "start", "length", "ids", "doc_tokens", "loss_tokens", "sequence_id", "offset"])
                used += int(sequence[-1]) + 1
            ids.clear(), found.clear(), prompts.clear()
            waiting = 0

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("id").type
            ends = [] if end_id is None else [end_id]
            keys, texts = batch.column("id").to_pylist(), batch.column("text")
            heads = batch.column("prompt") if prompt_col else None
            for row, key in enumerate(keys):
                head = encode(heads[row].as_py() or "") if prompt_col else []
                own = np.array(head + encode(texts[row].as_py() or "") + ends, "<u4")
                ids.append(key), found.append(own), prompts.append(len(head))
                waiting += len(own)
                if waiting >= group_tokens:
                    yield from flush()
        if found:
            yield from flush()
        give_back()

    return docs.select(*columns).mapInArrow(run, schema).withColumnRenamed("id", id_col)

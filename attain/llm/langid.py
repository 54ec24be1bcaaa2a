"""Language identification in two steps: the family first, then one-versus-one linear SVMs inside it."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attain.llm.common import LOWER, SHINGLE_CODES, chunks, give_back

# Families of language codes; any other code is in the family "other".
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ast ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indic": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
    "malayic": "id jv ms su tl",
    "sinitic": "yue zh",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
#: Hash bits of the character features, and the longest run of bytes that is one.
BITS = 15
RUN = 4
#: Labels of one family that are learned pair by pair; larger families are cut into blocks of labels.
BLOCK = 20
UNKNOWN = "und"

_CLASS = LOWER.copy()
_CLASS[[b for b in range(128) if not chr(b).isalpha()]] = 32


def features(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed runs of 1 to RUN bytes of letters-and-gaps texts: (RUN, n) indexes and the text offsets in n.

    Everything that is no letter is a gap of one space; runs stay inside their text, shorter at its end.
    """
    data = _CLASS[data]
    gap = data == 32
    again = np.zeros(len(data), bool)
    again[1:] = gap[1:] & gap[:-1]
    again[offsets[(offsets > 0) & (offsets < len(data))]] = False
    kept = np.concatenate([[0], np.cumsum(~again)])
    data, offsets = data[~again], kept[offsets]
    n = len(data)
    last = np.repeat(offsets[1:], np.diff(offsets))  # the end of each byte's text
    out = np.empty((RUN, n), np.uint16)
    value = np.zeros(n, np.uint64)
    wide = np.concatenate([data, np.zeros(RUN, np.uint8)]).astype(np.uint64) + np.uint64(1)
    at = np.arange(n)
    for k in range(RUN):
        part = wide[k:k + n] * SHINGLE_CODES[k]
        value = value + (np.where(at + k < last, part, np.uint64(0)) if k else part)
        out[k] = ((value * SHINGLE_CODES[8 + k]) >> np.uint64(64 - BITS)).astype(np.uint16)
    return out, offsets


def has_letter(column: pa.Array) -> np.ndarray:
    plain = pc.match_substring_regex(column, "[A-Za-z]").fill_null(False).to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(~plain):
        text = column[int(i)].as_py()
        plain[i] = bool(text) and any(c.isalpha() for c in text)
    return plain


def train_svm(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: float = 10.0, epochs: int = 20) -> np.ndarray:
    """A linear SVM with squared hinge loss by dual coordinate descent; rows are sparse (indexes, values)."""
    weights, alpha = np.zeros(1 << BITS), np.zeros(len(rows))
    diagonal = 0.5 / cost
    norms = np.array([float(v @ v) for _, v in rows]) + diagonal
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            index, value = rows[i]
            gradient = y[i] * float(weights[index] @ value) - 1 + diagonal * alpha[i]
            new = max(alpha[i] - gradient / norms[i], 0.0)
            if new != alpha[i]:
                weights[index] += (new - alpha[i]) * y[i] * value
                alpha[i] = new
    return weights


def train_slope(margin: np.ndarray, y: np.ndarray) -> float:
    """The slope of a logistic curve over margins, by Newton steps with a weak prior."""
    slope = 1.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(slope * margin * y, -30, 30)))
        step = (np.sum((1 - p) * margin * y) - 0.01 * slope) / (np.sum(p * (1 - p) * margin**2) + 0.01)
        slope = float(np.clip(slope + step, 0.1, 50))
    return slope


@dataclass(frozen=True)
class Model:
    """weights: (features, machines); the first len(families) machines are for the families (none if one)."""
    families: tuple[tuple[str, ...], ...]
    pairs: tuple[tuple[str, str], ...]
    weights: np.ndarray
    slopes: np.ndarray

    def classify(self, margin: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(margin)
        grown = 1 / (1 + np.exp(-np.clip(margin * self.slopes, -30, 30)))
        heads = len(self.families) if len(self.families) > 1 else 0
        share = grown[:, :heads] / grown[:, :heads].sum(1, keepdims=True) if heads else np.ones((n, 1))
        family = np.argmax(margin[:, :heads], 1) if heads else np.zeros(n, int)
        labels, score = np.empty(n, object), np.ones(n)
        machine = {pair: heads + i for i, pair in enumerate(self.pairs)}
        for f, langs in enumerate(self.families):
            rows = np.flatnonzero(family == f)
            votes, sure = np.zeros((len(rows), len(langs))), np.ones((len(rows), len(langs)))
            for a, b in combinations(range(len(langs)), 2):
                m, p = margin[rows, machine[langs[a], langs[b]]], grown[rows, machine[langs[a], langs[b]]]
                votes[:, a] += (m >= 0) + 1e-3 * p
                votes[:, b] += (m < 0) + 1e-3 * (1 - p)
                sure[:, a] *= p
                sure[:, b] *= 1 - p
            best = np.argmax(votes, 1)
            labels[rows] = np.array(langs, object)[best]
            picked = np.arange(len(rows)), best
            score[rows] = share[rows, f] * sure[picked] / np.maximum(sure.sum(1), 1e-300)
        return list(labels), np.clip(score, 0.0, 1.0)


def sample(train: DataFrame, text_col: str, lang_col: str, per_language: int) -> DataFrame:
    """At most per_language different texts of each language, picked by a hash of the text."""
    labelled = train.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    # a text is picked once for all its copies, so the share is one of different texts
    different = labelled.select("lang", F.xxhash64("text").alias("h")).distinct()
    shares = different.groupBy(F.col("lang").alias("of")).agg((2.0 * per_language / F.count("*")).alias("share"))
    spread = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = (labelled.join(F.broadcast(shares), F.col("lang") == F.col("of")).where(spread < F.col("share"))
           .groupBy("lang", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text")))
    order = Window.partitionBy("lang").orderBy("h")
    return few.withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_language).select("lang", "text")


def fit(train: DataFrame, *, text_col: str = "text", lang_col: str = "lang", per_language: int = 300) -> Model | None:
    """Fit on a bounded sample, per_language different texts of each label; their sparse features meet at the driver.

    Rows without label, text or letter are not used. Without any usable row there is no model (None).
    """
    def run(batches):
        for batch in batches:
            usable = has_letter(batch.column("text"))
            for row, offsets, data in chunks(batch.column("text")):
                found, at = features(offsets, data)
                for i in range(len(at) - 1):
                    if usable[row + i]:
                        index, count = np.unique(found[:, at[i]:at[i + 1]], return_counts=True)
                        value = (count / (at[i + 1] - at[i])).astype(np.float32)
                        yield pa.RecordBatch.from_arrays([batch.column("lang").slice(row + i, 1), pa.array([index.tobytes()]),
                                                          pa.array([value.tobytes()])], names=["lang", "index", "value"])

    got = sample(train, text_col, lang_col, per_language).mapInArrow(run, "lang string, index binary, value binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: (r["lang"], bytes(r["index"]), bytes(r["value"])))
    lang = [r["lang"] for r in got]
    rows = [(np.frombuffer(r["index"], np.uint16), np.frombuffer(r["value"], np.float32).astype(float)) for r in got]
    # weights by inverse document frequency and a scale that gives rows a norm of about one
    seen = np.zeros(1 << BITS)
    for index, _ in rows:
        seen[index] += 1
    weight = np.log((1 + len(rows)) / (1 + seen)) + 0.05
    rows = [(i, v * weight[i]) for i, v in rows]
    scale = 1 / np.sqrt(np.mean([v @ v for _, v in rows]))
    rows = [(i, v * scale) for i, v in rows]
    groups = defaultdict(list)
    for code in sorted(set(lang)):
        groups[FAMILY_OF.get(code, "other")].append(code)
    families = tuple(tuple(groups[k][i:i + BLOCK]) for k in sorted(groups) for i in range(0, len(groups[k]), BLOCK))
    pairs = tuple(p for langs in families for p in combinations(langs, 2))
    tasks = [([i for i in range(len(rows))], {c for c in langs}) for langs in families if len(families) > 1]
    tasks += [([i for i in range(len(rows)) if lang[i] in pair], {pair[0]}) for pair in pairs]
    weights, slopes = np.zeros((1 << BITS, len(tasks)), np.float32), np.ones(len(tasks))
    for t, (chosen, yes) in enumerate(tasks):
        own, y = [rows[i] for i in chosen], np.array([1.0 if lang[i] in yes else -1.0 for i in chosen])
        w = train_svm(own, y)
        slopes[t] = train_slope(np.array([float(w[i] @ v) for i, v in own]), y)
        weights[:, t] = w * weight * scale
    return Model(families, pairs, weights, slopes)


def predict(text: Column, model: Model | None) -> Column:
    """struct(lang, score) of whole texts. Null texts and texts without a letter are "und" with score 1;
    without a model every text is "und" with score 0."""
    sent = {"model": model}

    @F.arrow_udf("lang string, score double")
    def run(column: pa.Array) -> pa.Array:
        model = sent["model"]
        usable = has_letter(column)
        langs, scores = [UNKNOWN] * len(column), np.ones(len(column)) if model else np.zeros(len(column))
        if model and usable.any():
            for row, offsets, data in chunks(column):
                found, at = features(offsets, data)
                total = np.zeros((len(at) - 1, model.weights.shape[1]))
                full = np.flatnonzero(np.diff(at) > 0)
                if not len(full):
                    continue
                for k in range(RUN):
                    for m in range(model.weights.shape[1]):
                        total[full, m] += np.add.reduceat(model.weights[:, m][found[k]], at[full], dtype=np.float64)
                total[full] /= np.diff(at)[full][:, None]
                labels, score = model.classify(total)
                for i in np.flatnonzero(usable[row:row + len(at) - 1]):
                    langs[row + i], scores[row + i] = labels[i], score[i]
        give_back()
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores)], names=["lang", "score"])

    return run(text)


def identify(docs: DataFrame, model: Model | None, *, text_col: str = "text") -> DataFrame:
    """The documents with lang_pred and score (input columns of these names are replaced); only the text is read.

    Repeated rows get the same result, an empty table gives no rows, nulls in other columns do not matter.
    """
    kept = docs.drop("lang_pred", "score")
    found = kept.withColumn("__found", predict(F.col(text_col), model))
    return found.select(*kept.columns, F.col("__found.lang").alias("lang_pred"), F.col("__found.score").alias("score"))

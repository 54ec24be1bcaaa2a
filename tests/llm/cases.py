"""Small documents with what real tables hold: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, label int, id long, slot int, bits long, row string"


def frame(spark: SparkSession, rows: list[tuple[int | None, str | None]], langs: dict | None = None) -> DataFrame:
    langs = langs or {}
    return spark.createDataFrame([(i, t, langs.get(i), None, None if t is None else len(t), None, 7, None, 3, 1, 9, "x") for i, t in rows], SCHEMA)


def prose(seed: int, n: int, words: str = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau") -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(words.split()) + rng.choice(["", "", "x", "yy", "zzz"]) for _ in range(n))


def awkward() -> list[tuple[int | None, str | None]]:
    long = prose(1, 30_000)
    return [(1, None), (2, ""), (3, "   \t\n"), (4, "one"), (5, "One"), (6, long), (7, long), (8, prose(2, 200)), (8, prose(2, 200)),
            (9, prose(2, 200).upper()), (None, "no id here but five words and more"), (None, None), (10, "12345 !!! ---"),
            (11, "İstanbul été 你好 \U0001f600 word"), (12, "a" * 50_000), (13, "x\n" * 3000)]

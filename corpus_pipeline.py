"""A corpus pipeline over the table documents: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attain.llm import decontam, langid, linedup, minhash, packing
from attain.llm.common import Stages, table, without
from attain.llm.queries import tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; those without text or letter go."""
    model = langid.fit(docs)
    return docs.where(langid.predict(F.col("text"), model)["lang"] != langid.UNKNOWN) if model else docs.where(F.col("text").rlike(r"\p{L}"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines, with their new number of characters; those that lose all their text go."""
    out = linedup.dedup_lines(docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "text"),
                              max_edits=linedup.EDITS, exact_chars=linedup.EXACT_CHARS)
    left = out.where((F.col("n_dropped") == 0) | (F.btrim("text", F.lit(" \t\r\n")) != ""))
    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("doc.n_chars"))} if "n_chars" in docs.columns else {"text": F.col("text")}
    return left.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    return without(docs, "doc_id", minhash.near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("id")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in sequences of at most 2048."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: SQL cannot express support vector machines, edit joins or packing; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written and read again."""
    stages = Stages(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stages.write(docs)
    return docs

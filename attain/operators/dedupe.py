"""Keep-first and keep-latest reductions.

Both are aggregates rather than windows: every map task reduces its own copies of a key before
the shuffle, so a key that owns a large share of the rows never lands on one task as raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attain.operators.keys import Bitmap, fingerprint, repeated


def mark_repeats(df: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """df with a flag that is true for every row whose key another row has (and for a few others), false for the rest.

    One shuffle of fixed-width states, a 64-bit hash and a count for each key, combined before it; the hashes that repeat
    come back as a bitmap, so the rows themselves stay where they are.
    """
    hashes = df.select(fingerprint(df, keys).alias("h"))
    return Bitmap(repeated(hashes)).mark(df, fingerprint(df, keys), flag)


def least_rows(df: DataFrame, keys: list[str], copies: str = "_copies") -> DataFrame:
    """Smallest row per key in the order of the remaining columns, and how many copies there were."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_first"), F.count(F.lit(1)).alias(copies))
            .select(*keys, "_first.*", copies))


def keep_first(df: DataFrame, keys: list[str], copies: str | None = None) -> DataFrame:
    """Smallest row per key in the order of the remaining columns; optionally how many copies there were.

    Only rows whose key may repeat are shuffled and compared with each other; the others pass as they are read.
    """
    rest = [c for c in df.columns if c not in keys]
    marked = mark_repeats(df, keys, "_again")
    once = marked.where("NOT _again").select(*keys, *rest, F.lit(1).cast("long").alias("_copies"))
    kept = once.unionByName(least_rows(marked.where("_again").select(*keys, *rest), keys))
    return kept.withColumnRenamed("_copies", copies) if copies else kept.drop("_copies")


def keep_latest(df: DataFrame, keys: list[str], order: list[str], copies: str | None = None) -> DataFrame:
    """Row with the greatest value of the order columns per key."""
    rest = order + [c for c in df.columns if c not in keys and c not in order]
    aggregates = [F.max(F.struct(*rest)).alias("_last")]
    if copies:
        aggregates.append(F.count(F.lit(1)).alias(copies))
    kept = df.groupBy(*keys).agg(*aggregates)
    return kept.select(*keys, "_last.*", *([copies] if copies else []))


def surplus_rows(df: DataFrame, keys: list[str], name: str = "surplus", total: str = "_total") -> DataFrame:
    """One row: how many rows repeat a key that was already seen, and how many rows there are."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias(name),
                       F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias(total))

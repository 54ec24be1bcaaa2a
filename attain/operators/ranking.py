"""Exact ranks, positions and keys without putting a whole group on one task.

Values are cut into bins by a function that never reverses their order. Ranks inside a bin come
from a window per (group, bin); the rows above it are added from the bin totals. Ties are
collapsed before any window runs, so one value owned by a third of the rows is one row there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attain.sources.stage import store

BINS_PER_OCTAVE = 4096
#: Bins of infinities and of NaN, which sorts above every number.
INFINITE, NAN = 1 << 40, 1 << 41


def magnitude_bin(value: Column) -> Column:
    """Order-preserving bin of a number: fine near zero, logarithmic away from it."""
    v = value.cast("double")
    size = F.abs(v)
    finite = F.signum(v) * F.floor(F.log2(F.when(size < float("inf"), size).otherwise(0.0) + 1.0) * BINS_PER_OCTAVE)
    return (F.when(F.isnan(v), F.lit(NAN)).when(size == float("inf"), F.when(v > 0, INFINITE).otherwise(-INFINITE))
            .otherwise(finite.cast("long")))


def group_rank(df: DataFrame, by: list[str], value: str, rank: str | None = None, dense: str | None = None,
               descending: bool = True) -> DataFrame:
    """Add RANK and/or DENSE_RANK of a numeric column within groups; null values stay unranked.

    NaN counts as the largest value. The input's columns come first, in their order.
    """
    direction = F.desc if descending else F.asc
    spine = by or ["_all"]
    base = df if by else df.withColumn("_all", F.lit(0))
    values = (base.where(F.col(value).isNotNull()).groupBy(*spine, value).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_bin", magnitude_bin(F.col(value))))

    above = W.partitionBy(*spine).orderBy(direction("_bin")).rowsBetween(W.unboundedPreceding, -1)
    bins = (values.groupBy(*spine, "_bin").agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_values"))
            .select(*spine, "_bin", F.coalesce(F.sum("_rows").over(above), F.lit(0)).alias("_rows_above"),
                    F.coalesce(F.sum("_values").over(above), F.lit(0)).alias("_values_above")))

    inside = W.partitionBy(*spine, "_bin").orderBy(direction(value))
    before = inside.rowsBetween(W.unboundedPreceding, -1)
    placed = (values.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
              .withColumn("_pos", F.row_number().over(inside))
              .join(bins, [*spine, "_bin"]))
    columns = []
    if rank:
        columns.append((F.col("_rows_above") + F.col("_before") + 1).cast("long").alias(rank))
    if dense:
        columns.append((F.col("_values_above") + F.col("_pos")).cast("long").alias(dense))
    ranked = base.join(placed.select(*spine, value, *columns), [*spine, value], "left")
    return ranked.select(*df.columns, *[n for n in (rank, dense) if n])


def top_rows(df: DataFrame, value: str, key: str, share: float) -> DataFrame:
    """The first max(1, round(share * n)) rows by value, ties settled by the smaller key; also carries n.

    Values whose ties fit are taken whole; of the value at the edge, rows are taken by key.
    """
    ranked = group_rank(df, [], value, rank="_rank")
    ties = df.groupBy(value).agg(F.count(F.lit(1)).alias("_ties"))
    n_all = df.agg(F.count(F.lit(1))).scalar()
    sized = ranked.join(ties, value).withColumn("n_all", n_all).withColumn(
        "_k", F.greatest(F.lit(1), F.bround(F.col("n_all") * share)).cast("long"))
    sure = sized.where(F.col("_rank") + F.col("_ties") - 1 <= F.col("_k"))
    edge = sized.where((F.col("_rank") <= F.col("_k")) & (F.col("_rank") + F.col("_ties") - 1 > F.col("_k")))
    edge = (group_rank(edge, [], key, rank="_place", descending=False)
            .where(F.col("_place") <= F.col("_k") - F.col("_rank") + 1).drop("_place"))
    return sure.unionByName(edge).select(*df.columns, "n_all")


def dense_key(df: DataFrame, order: str, name: str, folder: str | None = None) -> DataFrame:
    """Surrogate keys 1..n in the order of a unique code, ahead of the other columns.

    The rows are range-partitioned and sorted by the code and written once; each row's place in its
    partition is then moved on by the rows of the partitions before it. Only one row per partition
    meets on a task.
    """
    place = F.monotonically_increasing_id()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = store(df.repartitionByRange(parts, order).sortWithinPartitions(order)
                   .withColumns({"_part": F.shiftright(place, 33), "_pos": place.bitwiseAND(F.lit((1 << 33) - 1))}), f"keys-{name}", folder=folder)
    earlier = W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
               .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")))
    return placed.join(offsets, "_part").select((F.col("_offset") + F.col("_pos") + 1).cast("long").alias(name), *df.columns)

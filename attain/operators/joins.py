"""Join helpers. Only the list of heavy keys, whose length is bounded, carries a broadcast hint: otherwise the planner
measures the sides and picks, and adaptive execution splits skewed partitions of the shuffled ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN_END = "2099-12-31"
#: Rows of one key that may meet in one task.
HEAVY_ROWS = 1 << 20
#: Dated values of one key that a row may meet at once.
LONG_HISTORY = 64
#: Rows of a table that the planner may broadcast, if it finds it small.
FEW = 1 << 19


def time_slice(day: Column, window: tuple | None) -> Column:
    """Calendar month of a day as a number, held inside the window (first and last day); one slice for all days without one."""
    if window is None:
        return F.when(day.isNotNull(), F.lit(0))
    month = F.year(day) * 12 + F.month(day)
    low, high = (d.year * 12 + d.month for d in window)
    return F.greatest(F.lit(low), F.least(F.lit(high), month))


def interval_lists(intervals: DataFrame, on: str, start: str, end: str, value: str, window: tuple | None = None) -> DataFrame:
    """One row per key and time slice with the dated values that touch the slice, in start order.

    Values starting on the same day are reduced first, so a list never has more entries than the calendar has days up to
    the end of its slice. Days before or after the window belong to its first or last slice, so every day has one; a value
    is copied to at most as many slices as the window has months.
    """
    daily = (intervals.groupBy(on, F.col(start).cast("date").alias("start"))
             .agg(F.max(F.struct(F.coalesce(F.col(end).cast("date"), F.lit(OPEN_END).cast("date")).alias("end"),
                                 F.col(value).alias("value"))).alias("_v"))
             .where(F.col("start").isNotNull() & (F.col("_v.end") >= F.col("start"))))
    slices = F.sequence(time_slice(F.col("start"), window), time_slice(F.col("_v.end"), window))
    return (daily.select(on, F.explode(slices).alias("_slice"), F.struct("start", F.col("_v.end").alias("end"), F.col("_v.value").alias("value")).alias("_e"))
            .groupBy(on, "_slice").agg(F.sort_array(F.collect_list("_e")).alias("_history")))


def point_in_time_join(df: DataFrame, intervals: DataFrame, on: str, at: str, value: str,
                       start: str = "start_date", end: str = "end_date", window: tuple | None = None) -> DataFrame:
    """Left join picking the value in force on a date; of several, the one that started last.

    window (first and last day of most dates) cuts the histories of more than LONG_HISTORY values into months: a row then
    meets only what touches its month, and the rows of such a key are spread over months. Shorter ones stay one row each,
    not one a month. Any window gives the same result.
    """
    held = intervals.where(F.col(on).isNotNull())
    covering = F.filter("_history", lambda h: (h["start"] <= F.col(at)) & (F.col(at) <= h["end"]))
    if window is None:
        history, placed = interval_lists(held, on, start, end, value), df.withColumn("_slice", time_slice(F.col(at), None))
    else:
        cut = held.groupBy(on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > LONG_HISTORY).select(F.col(on).alias("_on"))
        cut, same = F.broadcast(cut), F.col(on) == F.col("_on")
        history = interval_lists(held.join(cut, same, "left_anti"), on, start, end, value).unionByName(
            interval_lists(held.join(cut, same, "left_semi"), on, start, end, value, window))
        slice_ = F.when(F.col("_on").isNull(), time_slice(F.col(at), None)).otherwise(time_slice(F.col(at), window))
        placed = df.join(cut, same, "left").withColumn("_slice", slice_).drop("_on")
    return (placed.join(history, [on, "_slice"], "left")
            .withColumn(value, F.try_element_at(covering, F.lit(-1))["value"])
            .drop("_history", "_slice"))


def dated_join(df: DataFrame, intervals: DataFrame, on: str, at: str,
               start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Inner point-in-time join for histories whose intervals do not overlap (plain equi + range join)."""
    open_end = F.coalesce(F.col(end), F.lit(OPEN_END).cast("date"))
    right = intervals.select("*", open_end.alias("_end")).drop(end).withColumnRenamed(on, "_on")
    return (df.join(right, (df[on] == right["_on"]) & (df[at] >= right[start]) & (df[at] <= right["_end"]))
            .drop("_on", "_end", start))


def spread_lookup_join(df: DataFrame, lookup: DataFrame, on: str, rows: str, spread_by: list[str], heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Left join of df to a table of one row per key that carries how many rows of df (at least) have the key.

    Keys with more than heavy_rows rows are cut: their rows are dealt over as many parts as that takes, by a hash of the
    columns spread_by, and their row of the lookup is copied to each part. There are at most (rows of df / heavy_rows) such
    keys, so their list is broadcast. Rows without a key find nothing and are dealt over 1024 parts. The column `rows`
    is not in the result.
    """
    copies = F.ceil(F.col(rows) / F.lit(heavy_rows)).cast("int")
    heavy = lookup.where(F.col(rows) > heavy_rows).select(F.col(on).alias("_on"), copies.alias("_copies"))
    part = F.pmod(F.xxhash64(*spread_by), F.when(F.col(on).isNull(), 1024).otherwise(F.coalesce("_copies", F.lit(1)))).cast("int")
    dealt = df.join(F.broadcast(heavy), F.col(on) == F.col("_on"), "left").withColumn("_part", part).drop("_on", "_copies")
    parts = F.explode(F.sequence(F.lit(0), F.greatest(copies, F.lit(1)) - 1)).alias("_part")
    copied = lookup.select(*[c for c in lookup.columns if c != rows], parts)
    return dealt.join(copied, [on, "_part"], "left").drop("_part")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows of a small table dealt by key over as many tasks as a shuffle has, before each of them becomes many rows:
    the planner sizes tasks by what they read, not by what they make."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def many(df: DataFrame) -> DataFrame:
    """A side of a join that is merged and never broadcast: rows made by explode, or read back from a stage table of them.

    The planner takes the former for as small as the rows they were made of, and the latter for as small as their
    compressed files; both may be millions of rows where it sees a few megabytes.
    """
    return df.hint("merge")


def sized(df: DataFrame) -> DataFrame:
    """A written table for joins: left to the planner with FEW rows at most, merged beyond. Its rows are counted (from the
    footers of its files), as the planner knows only how many bytes they are compressed to."""
    return many(df) if df.count() > FEW else df


def band_join(df: DataFrame, bands: DataFrame, on: str, value: str,
              floor: str = "band_floor", ceiling: str = "band_ceiling") -> DataFrame:
    """Left join to the half-open band [floor, ceiling) of the same plan; a null edge is open."""
    right = bands.withColumnRenamed(on, "_on")
    inside = ((right[floor].isNull() | (df[value] >= right[floor]))
              & (right[ceiling].isNull() | (df[value] < right[ceiling])) & df[value].isNotNull())
    return df.join(right, (df[on] == right["_on"]) & inside, "left").drop("_on", floor, ceiling)


def one_row(*parts: DataFrame) -> DataFrame:
    """Put one-row results with different columns side by side without a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])

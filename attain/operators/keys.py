"""Exact key tests on fixed-width states: repeated keys by fingerprints, known keys by bitmaps.

What is broadcast is a bitmap of at most WORDS rows of 16 bytes, whatever the data. It only says where nothing more needs
to be done; the rows that remain in doubt are compared by their keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a bitmap of 64 bits each.
WORDS = 1 << 20

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def one_bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(position, F.lit(64)).cast("int"))


def fingerprint(df: DataFrame, columns: list[str], salt: str = "") -> Column:
    """64-bit hash that is the same for keys that are equal; zeros of either sign are."""
    zero = (T.FloatType, T.DoubleType)
    parts = [F.col(c) + F.lit(0).cast(df.schema[c].dataType) if isinstance(df.schema[c].dataType, zero) else F.col(c) for c in columns]
    return F.xxhash64(*([F.lit(salt)] if salt else []), *parts)


def repeated(hashes: DataFrame) -> DataFrame:
    """The fingerprints (column h) that more than one row has: a hash aggregate of longs, combined before the shuffle."""
    return hashes.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")


@dataclass(frozen=True)
class Bitmap:
    """Fingerprints as bits: a row for each word that holds any, WORDS at most. It may hold more of them, never fewer."""

    hashes: DataFrame

    @staticmethod
    def place() -> Column:
        return F.shiftrightunsigned("h", 6).bitwiseAND(F.lit(WORDS - 1).cast("long"))

    def words(self) -> DataFrame:
        return self.hashes.groupBy(self.place().alias("_word")).agg(F.bit_or(one_bit(F.col("h"))).alias("_bits"))

    @staticmethod
    def hit() -> Column:
        return F.coalesce(F.col("_bits").bitwiseAND(one_bit(F.col("h"))) != 0, F.lit(False))

    def mark(self, df: DataFrame, h: Column, flag: str) -> DataFrame:
        """df with a flag that is true for rows whose fingerprint may be among them, and no other false."""
        placed = df.withColumn("h", h).withColumn("_word", self.place())
        return placed.join(F.broadcast(self.words()), "_word", "left").withColumn(flag, self.hit()).drop("h", "_word", "_bits")

    def among(self, df: DataFrame) -> DataFrame:
        """The rows of df (with its fingerprint h) that may be among them; nothing is read where there are none."""
        return (df.withColumn("_word", self.place()).join(F.broadcast(self.words()), "_word").where(self.hit())
                .drop("_word", "_bits"))


def stacked(parts: list[DataFrame]) -> DataFrame:
    """All rows of many tables of equal columns, put together in a balanced tree: planning time grows with their number only."""
    while len(parts) > 1:
        parts = [a.unionAll(b) for a, b in zip(parts[::2], parts[1::2])] + (parts[-1:] if len(parts) % 2 else [])
    return parts[0]


# --------------------------------------------------------------------------- many keys at once
@dataclass(frozen=True)
class Key:
    """A key of a table under a name; only the rows that meet `where` count."""

    what: str
    table: DataFrame
    columns: tuple[str, ...]
    where: Column | None = None

    def rows(self) -> DataFrame:
        return self.table if self.where is None else self.table.where(self.where)

    def is_integer(self) -> bool:
        return len(self.columns) == 1 and isinstance(self.table.schema[self.columns[0]].dataType, _INTEGERS)


def _slots(keys: list[Key]) -> list[DataFrame]:
    """Each key's columns as (what, integers as longs, everything else as text), so that keys of all types fit one table."""
    def split(key: Key):
        whole = [c for c in key.columns if isinstance(key.table.schema[c].dataType, _INTEGERS)]
        return whole, [c for c in key.columns if c not in whole]

    longs, texts = (max(len(split(k)[i]) for k in keys) for i in (0, 1))
    out = []
    for key in keys:
        whole, other = split(key)
        columns = [F.col(whole[i]).cast("long").alias(f"_l{i}") if i < len(whole) else F.lit(None).cast("long").alias(f"_l{i}") for i in range(longs)]
        columns += [F.col(other[i]).cast("string").alias(f"_t{i}") if i < len(other) else F.lit(None).cast("string").alias(f"_t{i}") for i in range(texts)]
        out.append(key.rows().select(F.lit(key.what).alias("what"), *columns))
    return out


def repeats(keys: list[Key]) -> DataFrame:
    """(what, failing_rows): rows whose key another row has, less one for each key. Null parts are values like any other.

    All keys of all tables meet in one aggregate of 64-bit fingerprints. Only rows whose fingerprint repeats are read
    again and compared by the key itself; without any, nothing is.
    """
    rows = stacked(_slots(keys))
    parts = [c for c in rows.columns if c != "what"]
    rows = rows.withColumn("h", F.xxhash64("what", *parts))
    doubt = Bitmap(repeated(rows.select("h"))).among(rows)
    return (doubt.groupBy("what", *parts).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            .groupBy("what").agg(F.sum(F.col("n") - 1).alias("failing_rows")))


def unknown(keys: list[tuple[Key, Key]]) -> DataFrame:
    """(what, failing_rows): rows whose key (the first of a pair) is in no row of its parent (the second). Null keys do not count.

    Integer keys from 0 on, as surrogate keys are, meet an exact bitmap of the parent and are settled in the scan: all
    bitmaps together have at most WORDS rows. Other keys are counted by a hash aggregate, and the counted ones looked up.
    """
    held = max(1, WORDS // len(keys)) * 64
    children = [child for child, _ in keys]
    parents = [Key(child.what, parent.table, parent.columns, parent.where) for child, parent in keys]
    both = _slots(children + parents)
    pairs = list(zip(both, both[len(keys):], (c.is_integer() and p.is_integer() for c, p in keys)))
    inside = F.col("_l0").between(0, held - 1)
    fine = [(c.where(inside), p.where(inside)) for c, p, whole in pairs if whole]
    rest = [(c.where(~inside), p.where(~inside)) if whole else (c, p) for c, p, whole in pairs]

    found = []
    if fine:
        children, parents = stacked([c for c, _ in fine]), stacked([p for _, p in fine])
        word = F.shiftright("_l0", 6).alias("_word")
        words = parents.groupBy("what", word).agg(F.bit_or(one_bit(F.col("_l0"))).alias("_bits"))
        missing = F.coalesce(F.col("_bits").bitwiseAND(one_bit(F.col("_l0"))) == 0, F.lit(True))
        probed = children.select("what", "_l0", word).join(F.broadcast(words), ["what", "_word"], "left")
        found.append(probed.where(missing).groupBy("what").agg(F.count(F.lit(1)).alias("failing_rows")))
    rows, parents = stacked([c for c, _ in rest]), stacked([p for _, p in rest])
    parts = [c for c in rows.columns if c != "what"]
    some = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in parts])
    counted = rows.where(some).groupBy("what", *parts).agg(F.count(F.lit(1)).alias("n"))
    sides = [F.col(f"_p_{c}") for c in parts]
    looked = parents.distinct().select(F.col("what").alias("_p_what"), *[F.col(c).alias(f"_p_{c}") for c in parts])
    # a single key column is never null here, so plain equality finds it; what is null on both sides is no part of the key
    same = reduce(lambda a, b: a & b, [F.coalesce(F.col(c).cast("string"), F.lit("")) == F.coalesce(s.cast("string"), F.lit("")) for c, s in zip(parts, sides)],
                  (F.col("what") == F.col("_p_what")))
    found.append(counted.join(looked, same, "left_anti").groupBy("what").agg(F.sum("n").alias("failing_rows")))
    return reduce(DataFrame.unionByName, found).groupBy("what").agg(F.sum("failing_rows").alias("failing_rows"))


def with_known(df: DataFrame, masters: dict[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """df with a flag for each master (flag -> key column, master, its integer key): whether the key is known; a null is not.

    Keys from 0 on meet exact bitmaps in the scan; rows with any other key are joined with the masters themselves.
    """
    held = max(1, WORDS // len(masters)) * 64
    inside = reduce(lambda a, b: a & b, [F.coalesce(F.col(c).between(0, held - 1), F.lit(True)) for c, _, _ in masters.values()])
    near, far = df.where(inside), df.where(~inside)
    for flag, (column, master, key) in masters.items():
        words = (master.where(F.col(key).between(0, held - 1)).groupBy(F.shiftright(F.col(key).cast("long"), 6).alias("_word"))
                 .agg(F.bit_or(one_bit(F.col(key))).alias("_bits")))
        near = (near.withColumn("_word", F.shiftright(F.col(column).cast("long"), 6)).join(F.broadcast(words), "_word", "left")
                .withColumn(flag, F.coalesce(F.col("_bits").bitwiseAND(one_bit(F.col(column))) != 0, F.lit(False))).drop("_word", "_bits"))
        keys = master.select(F.col(key).alias("_key"), F.lit(True).alias(flag)).where("_key IS NOT NULL").distinct()
        far = far.join(keys, F.col(column) == F.col("_key"), "left").drop("_key").withColumn(flag, F.coalesce(flag, F.lit(False)))
    return near.unionByName(far)

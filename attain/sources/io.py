"""Readers and writers: CSV extracts in, parquet tables out."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attain.schema import RAW


def read_checked(spark: SparkSession, path: str, schema: str, step: str) -> DataFrame:
    """Read a CSV with a fixed schema; a missing file names the step that should have written it."""
    try:
        return spark.read.schema(schema).csv(path, header=True, ignoreLeadingWhiteSpace=False,
                                             ignoreTrailingWhiteSpace=False)
    except AnalysisException as error:
        raise FileNotFoundError(f"input '{path}' not found; run the step '{step}' first") from error


def read_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The ten raw extracts of a folder."""
    return {name: read_checked(spark, f"{folder.rstrip('/')}/raw_{name}.csv", schema, "extract")
            for name, schema in RAW.items()}


def project(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    """Declared columns in declared order; fails when any is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    return df.select(*columns)


def write_table(df: DataFrame, folder: str, name: str, partition_by: str | None = None,
                sort_by: list[str] | None = None) -> str:
    """Overwrite one parquet table. Partitioned tables are rebalanced by the partition column: adaptive
    execution merges small months and cuts a heavy one into as many tasks as its size asks for."""
    path = f"{folder.rstrip('/')}/{name}"
    if partition_by:
        df = df.hint("rebalance", partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*([partition_by] if partition_by else []), *sort_by)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return path


def write_model(tables: dict[str, DataFrame], folder: str) -> None:
    """Every model table; the sales fact by month, sorted by date and line."""
    for name, df in tables.items():
        if name == "fact_sales":
            write_table(df, folder, name, "month_key", ["date_key", "line_id"])
        else:
            write_table(df, folder, name)


def with_first_day(df: DataFrame) -> DataFrame:
    """KPI tables relate to the calendar through the first day of their month."""
    return df.withColumn("date_key", (F.col("month_key") * 100 + 1).cast("int"))


def write_kpis(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        write_table(with_first_day(df), folder, name)


def write_answers(answers: dict[str, DataFrame], folder: str) -> list[str]:
    """One output per named question."""
    return [write_table(df, folder, name) for name, df in answers.items()]


def write_record(df: DataFrame, path: str) -> None:
    """A one-row record as JSON."""
    df.write.mode("overwrite").json(path)


def first_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """The n rows with the smallest key."""
    return df.orderBy(key).limit(n)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows picked by a seeded hash of their key: the same rows however the table is partitioned."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string"))), key).limit(n)

"""The date-partitioned Parquet lake.

Partition values are zero-padded strings on write (``year=2024/month=01``) and
come back as integers through partition discovery; filters on them prune
directories before any file is opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.fixed import LAKE_COLUMNS
from cadenza.functions.dates import run_date_parts

PARTITIONS = ["year", "month", "day"]

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "float": T.FloatType()}
LAKE_SCHEMA = T.StructType([T.StructField(n, _TYPES[t], True) for n, t in LAKE_COLUMNS])


def with_run_date(df: DataFrame, run_date: str) -> DataFrame:
    """Constant partition columns for one run date."""
    y, m, d = run_date_parts(run_date)
    return df.withColumns({"year": F.lit(y), "month": F.lit(m), "day": F.lit(d)})


def date_partitions(ts: Column) -> dict[str, Column]:
    """N12 per row: zero-padded year / month / day of a timestamp column."""
    return {"year": F.date_format(ts, "yyyy"), "month": F.date_format(ts, "MM"),
            "day": F.date_format(ts, "dd")}


def write_lake(df: DataFrame, path: str, mode: str = "append") -> None:
    """Dynamic partitions year/month/day.

    Rows are rebalanced on the partition columns: AQE splits a large day (a daily run
    has one value) over tasks of the advisory size and merges small ones, so a backfill
    does not write a file per task and day.
    """
    (df.hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS)
       .write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .partitionBy(*PARTITIONS).parquet(path))


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """The whole lake (partition columns inferred as integers)."""
    return spark.read.parquet(path)


def read_lake_day(spark: SparkSession, path: str, run_date: str,
                  drop_partitions: bool = True) -> DataFrame:
    """One day's partition; the equality filters become PartitionFilters."""
    y, m, d = (int(x) for x in run_date_parts(run_date))
    df = read_lake(spark, path).where(
        (F.col("year") == y) & (F.col("month") == m) & (F.col("day") == d))
    return df.drop(*PARTITIONS) if drop_partitions else df


def read_lake_days(spark: SparkSession, path: str, days: DataFrame, date: str = "date") -> DataFrame:
    """S9/F7 for many days in one run: the partitions that ``days`` (a filtered table of dates) names.

    The lake joins the dates on its partition columns.  Spark reads the dates first and prunes the lake's
    folders with them at run time (dynamic partition pruning), so no list of days passes through the driver
    and other folders are not opened.  A date named twice counts once.
    """
    wanted = days.select(F.year(date).alias("year"), F.month(date).alias("month"), F.dayofmonth(date).alias("day")).distinct()
    return read_lake(spark, path).join(wanted, PARTITIONS)


def since(lake: DataFrame, date: str) -> DataFrame:
    """Rows of the partitions of ``date`` and later (partition filters)."""
    y, m, d = (int(x) for x in run_date_parts(date))
    return lake.where((F.col("year") > y) | ((F.col("year") == y) & (
        (F.col("month") > m) | ((F.col("month") == m) & (F.col("day") >= d)))))

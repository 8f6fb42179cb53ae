"""Per-source run state (high-water marks) as an append-only table.

One row per (source, run): ``source string, last_time timestamp, committed_at
timestamp``.  State is committed *after* the data it covers has been written,
so a crash re-reads posts instead of losing them (downstream de-duplicates by
post id).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.sources.missing import or_none

STATE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("last_time", T.TimestampNTZType()),
    T.StructField("committed_at", T.TimestampNTZType()),
])


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The state table, or an empty frame on the first run."""
    found = or_none(lambda: spark.read.schema(STATE_SCHEMA).parquet(path))
    return spark.createDataFrame([], STATE_SCHEMA) if found is None else found


def latest_marks(history: DataFrame) -> DataFrame:
    """S12/O1 per source: the row with the latest ``last_time`` (ties: latest commit).

    An aggregate (``max_by``) rather than a sort, so it runs as a partial +
    final hash aggregate however many rows the history holds.
    """
    return (history.groupBy("source")
            .agg(F.max_by(F.struct("last_time", "committed_at"),
                          F.struct("last_time", "committed_at")).alias("_r"))
            .select("source", "_r.last_time", "_r.committed_at"))


def latest_row(history: DataFrame, order_col: str = "last_time") -> DataFrame:
    """O1 as the original: the single newest row (``ORDER BY … DESC LIMIT 1``, TakeOrderedAndProject)."""
    return history.orderBy(F.col(order_col).desc(), F.col("committed_at").desc()).limit(1)


def marks_with_default(rules: DataFrame, latest: DataFrame, run_date: str) -> DataFrame:
    """Every feed of the rules gets a mark; first run = midnight of the run date."""
    midnight = _dt.datetime.fromisoformat(str(run_date)[:10])
    return (rules.select("source").join(latest, "source", "left")
            .select("source", F.coalesce("last_time", F.lit(midnight).cast("timestamp_ntz"))
                    .alias("last_time")))


def commit_state(new_marks: DataFrame, path: str, committed_at: _dt.datetime) -> None:
    """Append one row per source (call after the data write succeeded)."""
    (new_marks.select("source", F.col("new_time").alias("last_time"),
                      F.lit(committed_at).cast("timestamp_ntz").alias("committed_at"))
     .write.mode("append").parquet(path))

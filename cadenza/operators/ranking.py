"""Order-dependent helpers expressed as scalable DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """Top ``k`` rows per group in ``order`` (1-based ``rank_col``).

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so at most ``k`` rows per group leave each map task even when
    one group holds a third of all rows.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def first_per_group(df: DataFrame, keys: list[str], order: Column,
                    cols: list[str] | None = None) -> DataFrame:
    """Keep the first row per group in ``order`` as an aggregate (``min_by``).

    Partial aggregation map-side keeps hot groups cheap (no window over one
    huge partition).
    """
    cols = cols or [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
            .agg(F.min_by(F.struct(*cols), order).alias("_first"))
            .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in cols]))


def global_row_number(df: DataFrame, order: list[Column], out: str = "n",
                      partitions: int | None = None) -> DataFrame:
    """1-based consecutive row number over the whole frame in ``order``.

    ``row_number()`` without PARTITION BY runs in one task.  Instead: range
    partition on the order, number rows inside each partition (one task per
    partition), count rows per partition (a tiny table, one row per
    partition), turn the counts into offsets and add them.

    The range bounds come from sampling the input, so two evaluations of an
    input whose row order is not fixed (e.g. a join output) can partition
    differently; the numbered frame is therefore materialised once with a
    reliable ``checkpoint()`` in the shared checkpoint folder, and counts and
    offsets are taken from that same copy.  Ties in ``order`` must be broken by
    the caller so the numbering is deterministic.
    """
    from cadenza.session import checkpoint_dir
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    w = W.partitionBy("_pid").orderBy(*order)
    numbered = (df.repartitionByRange(n, *order)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_local", F.row_number().over(w))
                .checkpoint(eager=True))
    counts = numbered.groupBy("_pid").agg(F.max("_local").alias("_cnt"))
    offsets = counts.select(
        "_pid", (F.sum("_cnt").over(W.orderBy("_pid")) - F.col("_cnt")).alias("_off"))
    return (numbered.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + F.col("_local"))
            .drop("_pid", "_off", "_local"))

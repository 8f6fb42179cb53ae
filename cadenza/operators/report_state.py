"""The daily report kept up to date by batches, late rows included.

The state is one row of partial sums per day, genre list and batch, in Parquet partitioned by
``day`` and ``batch``.  A batch of new rows, of whatever days, is reduced to its partial sums and
written once; a batch that is run again replaces its own partitions, so nothing counts twice.  The report of
any day is the sum of its batches: no lake row is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.fixed import GENRE_LABELS
from cadenza.operators.labels import with_major_genre
from cadenza.operators.reports import AVG_COLUMNS, PARTIAL_COLUMNS, REPORT_COLUMNS, genre_partials
from cadenza.sources.missing import or_none


def absorb(rows: DataFrame, path: str, batch: str, day: str = "day") -> DataFrame:
    """Add the lake rows of one batch (``day`` as yyyy-mm-dd) to the state; the days it touches."""
    spark = rows.sparkSession
    days = or_none(lambda: spark.read.parquet(path).where(F.col("batch") == batch).select("day").distinct().collect())
    partial = genre_partials(rows.withColumn("_key", F.struct(F.col(day).cast("string").alias("day"), "genres")), "_key")
    partial = partial.select("_key.genres", *PARTIAL_COLUMNS, F.lit(batch).alias("batch"), "_key.day")
    if days:  # a day that an earlier attempt had and this one lacks must not keep the old sums
        partial = partial.unionByName(spark.createDataFrame([(str(r["day"]),) for r in days], "day string")
                                      .select(F.lit(None).cast("string").alias("genres"), *[F.lit(0).cast(partial.schema[c].dataType).alias(c) for c in PARTIAL_COLUMNS],
                                              F.lit(batch).alias("batch"), "day"))
    (partial.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(path))
    return read_state(spark, path).where(F.col("batch") == batch).select("day").distinct()


def read_state(spark: SparkSession, path: str) -> DataFrame:
    state = spark.read.parquet(path)
    return state.withColumns({"day": F.col("day").cast("string"), "batch": F.col("batch").cast("string")}).where("_n > 0")


def report(spark: SparkSession, path: str, days: list[str] | None = None, labels: list[str] = GENRE_LABELS) -> DataFrame:
    """Report rows of all days, or of some (a partition filter), from the state alone.

    Means are rounded to 9 places first, so that one on the edge of the third does not depend on the
    order in which batches were added up.
    """
    state = read_state(spark, path)
    if days is not None:
        state = state.where(F.col("day").isin(days))
    per_list = state.groupBy("day", "genres").agg(*[F.sum(c).alias(c) for c in PARTIAL_COLUMNS])
    sums = (with_major_genre(per_list, "genres", "Genre", labels).groupBy("day", "Genre")
            .agg(*[F.sum(c).alias(c) for c in PARTIAL_COLUMNS]))
    avg = {c: F.try_divide(F.col(f"_s_{c}"), F.col(f"_c_{c}")) for c in AVG_COLUMNS}
    date = F.to_date("day")
    return sums.select(
        "Genre", F.col("_n").alias("NumberOfSongs"), F.floor(avg["track_popularity"]).cast("bigint").alias("Popularity"),
        *[F.round(F.round(avg[c], 9), 3).alias(AVG_COLUMNS[c]) for c in AVG_COLUMNS if c != "track_popularity"],
        F.date_format(date, "yyyy").alias("year"), F.date_format(date, "MM").alias("month"), F.date_format(date, "dd").alias("day")).select(*REPORT_COLUMNS)

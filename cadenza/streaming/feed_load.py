"""Incremental feed load as a file-source stream.

Landed feed pages (JSON) -> posts -> newer than the per-source mark (a
stream-static broadcast join with the state table) -> de-duplicated by post id
within the event-time watermark -> Parquet sink with a checkpoint.  With
``availableNow`` the query processes everything landed so far and stops, so
the same code serves scheduled catch-up runs and a continuous service.

Late-data rule: a post older than (latest post time seen - ``delay``) may be
dropped by the de-duplication state; the batch path (T2) applies no delay.
Within one trigger nothing is late, so a catch-up run is whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.sources.landed import FEED_SCHEMA, feed_posts, pages_while


def stream_new_posts(spark: SparkSession, landing: str, marks: DataFrame,
                     delay: str = "1 day", max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(FEED_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    posts = feed_posts(reader.json(landing))
    return (posts.join(F.broadcast(marks), "source")
            .where(F.col("created") > F.col("last_time"))
            .withColumn("event_time", F.col("created").cast("timestamp"))
            .withWatermark("event_time", delay)
            .dropDuplicatesWithinWatermark(["post_id"]))


def stream_while(spark: SparkSession, landing: str, marks: DataFrame, max_files: int | None = None,
                 delay: str | None = None) -> DataFrame:
    """New posts by the batch's own rule (F1): each landed page up to its first post that is not newer than the
    mark, de-duplicated by post id.

    Equal to the batch for any ``max_files`` and any order inside a page.  Without ``delay`` every post id
    ever seen is kept as state, so nothing is late; with one, ids are kept for that event time.
    """
    reader = spark.readStream.schema(FEED_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    pages = reader.json(landing).withColumn("file", F.input_file_name()).join(F.broadcast(marks), "source")
    posts = feed_posts(pages_while(pages), F.col("file"))
    if delay is None:
        return posts.dropDuplicates(["post_id"])
    return (posts.withColumn("event_time", F.col("created").cast("timestamp")).withWatermark("event_time", delay)
            .dropDuplicatesWithinWatermark(["post_id"]).drop("event_time"))


def stream_accepted_posts(spark: SparkSession, landing: str, rules: DataFrame, marks: DataFrame,
                          delay: str = "1 day", max_files: int | None = None) -> DataFrame:
    """The feed half of the extract job as a stream: newer than the mark (filter mode -
    a take-while needs the whole feed, and equals the filter on a newest-first feed),
    then the stateless post rules, de-duplicated by post id within the watermark."""
    from cadenza.operators.feeds import attach_rules
    from cadenza.operators.ingest import post_rules
    reader = spark.readStream.schema(FEED_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    posts = attach_rules(feed_posts(reader.json(landing)), rules).join(F.broadcast(marks), "source")
    return (post_rules(posts.where(F.col("created") > F.col("last_time")))
            .select("source", "post_id", "created_utc", "created", "post_title", "part0", "part1",
                    "searching_context", "post_url")
            .withColumn("event_time", F.col("created").cast("timestamp"))
            .withWatermark("event_time", delay)
            .dropDuplicatesWithinWatermark(["post_id"])
            .drop("event_time"))


def run_stream(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """availableNow run of a stream into a Parquet sink with its checkpoint."""
    q = (stream.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def run_feed_load(spark: SparkSession, landing: str, marks: DataFrame, sink: str,
                  checkpoint: str, delay: str = "1 day") -> None:
    """Process everything landed so far (availableNow) into the Parquet sink."""
    q = (stream_new_posts(spark, landing, marks, delay)
         .drop("last_time", "event_time")
         .writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def run_extract_stream(spark: SparkSession, landing: str, rules: DataFrame, state_path: str,
                       lake_path: str, checkpoint: str, run_ts, delay: str = "1 day",
                       max_files: int | None = None) -> None:
    """The whole extract job as a stream: landed pages are parsed and de-duplicated by
    post id in the stream; every micro-batch then runs the batch extract work in
    filter mode (``foreachBatch``).  All micro-batches are held against the marks of
    the run's start and the newest marks are committed after the last one, so the
    result does not depend on the batch size (``max_files``).  The lake append skips
    posts already stored, so a replayed micro-batch adds nothing."""
    from pyspark.sql import functions as F

    from cadenza.operators.ingest import extract_posts
    from cadenza.sources import state as ST

    start = ST.marks_with_default(rules, ST.latest_marks(ST.read_state(spark, state_path)), run_ts.date().isoformat())
    start = spark.createDataFrame(start.collect(), start.schema)  # one row per feed
    found = []
    reader = spark.readStream.schema(FEED_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    posts = (feed_posts(reader.json(f"{landing}/pages"))
             .withColumn("event_time", F.col("created").cast("timestamp"))
             .withWatermark("event_time", delay)
             .dropDuplicatesWithinWatermark(["post_id"])
             .drop("event_time"))

    def batch(df: DataFrame, epoch_id: int) -> None:
        # persisted so the emptiness check and the extract read the batch once; the
        # no-data batches that only advance the watermark do no extract work
        df = df.persist()
        try:
            if not df.isEmpty():
                found.append(extract_posts(df.sparkSession, df, landing, rules, state_path, lake_path,
                                           run_ts, "filter", start).collect())
        finally:
            df.unpersist()

    q = (posts.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    rows = [r for batch_rows in found for r in batch_rows]
    if rows:
        new = spark.createDataFrame(rows, "source string, new_time timestamp_ntz")
        ST.commit_state(new.groupBy("source").agg(F.max("new_time").alias("new_time")), state_path, run_ts.replace(tzinfo=None))

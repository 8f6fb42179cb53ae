"""Feed-side operators: rules (F2-F4, P7, U1), take-while (F1, J7, O2), watermark (A5).

A feed post frame has at least ``source`` (feed key), a position order and a
post time.  Rules live in a small DataFrame (one row per feed, fixed size),
so all feeds are processed in one pass instead of one loop per feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.fixed import FEED_RULES, PERMALINK_PREFIX

RULES_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("ord", T.IntegerType()),
    T.StructField("feed", T.StringType()),
    T.StructField("flair_rule", T.StringType()),
    T.StructField("flair_values", T.ArrayType(T.StringType())),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("permalink_prefix", T.StringType()),
])


def rules_table(spark: SparkSession, sources: dict[str, str] | None = None) -> DataFrame:
    """The feed rules as a DataFrame; ``sources`` maps a source key to a feed name
    (default: the feed name is its own key)."""
    by_feed = {feed: key for key, feed in (sources or {}).items()}
    rows = [(by_feed.get(feed, feed) if sources else feed, ord_, feed, rule, vals, tags,
             PERMALINK_PREFIX.format(feed=feed))
            for ord_, feed, rule, vals, tags in FEED_RULES]
    return spark.createDataFrame(rows, RULES_SCHEMA)


def flair_passes(flair: Column, rule: Column, values: Column) -> Column:
    """F2-F4 with Python semantics: a missing flair passes '!=' and 'not in', fails 'in'."""
    inside = F.coalesce(F.array_contains(values, flair), F.lit(False))
    return (F.when(rule.isNull(), F.lit(True))
            .when(rule == "ne", ~flair.eqNullSafe(F.element_at(values, 1)))
            .when(rule == "in", inside)
            .when(rule == "nin", ~inside)
            .otherwise(F.lit(False)))


def attach_rules(posts: DataFrame, rules: DataFrame) -> DataFrame:
    """One pass over all feeds; the rules table is tiny and fixed, so broadcast."""
    return posts.join(F.broadcast(rules), "source")


def apply_flair_rules(posts_with_rules: DataFrame, flair: str = "flair") -> DataFrame:
    return posts_with_rules.where(
        flair_passes(F.col(flair), F.col("flair_rule"), F.col("flair_values")))


def take_while(df: DataFrame, keys: list[str], order: Column, keep: Column,
               broadcast_stops: bool = True) -> DataFrame:
    """per group, keep rows in ``order`` up to (not including) the first row failing ``keep``.

    Written without a window: the stop point of each group is the smallest
    order key among failing rows, a plain aggregate with map-side partial
    aggregation, so a group holding a third of all rows is still spread over
    every task.  The stop table has one row per group key; for feeds (keys from
    the fixed rules table) that is a proven bound and it is broadcast.  Pass
    ``broadcast_stops=False`` for unbounded keys: AQE then picks the join and
    splits a skewed group.
    """
    tagged = df.withColumn("_ord", order)
    stops = (tagged.where(~F.coalesce(keep, F.lit(False)))
             .groupBy(*keys).agg(F.min("_ord").alias("_stop")))
    return (tagged.join(F.broadcast(stops) if broadcast_stops else stops, keys, "left")
            .where(F.col("_stop").isNull() | (F.col("_ord") < F.col("_stop")))
            .drop("_ord", "_stop"))


def newest_first(df: DataFrame, keys: list[str], page_size: int) -> DataFrame:
    """O2: at most ``page_size`` newest rows per group (one pull of the feed API)."""
    from pyspark.sql import Window as W
    w = W.partitionBy(*keys).orderBy(F.col("created").desc(), F.col("post_id"))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= page_size).drop("_rn")


def advance_watermark(accepted: DataFrame, state: DataFrame, order: Column,
                      time_col: str = "created", pull: str | None = None) -> DataFrame:
    """A5: new mark per source = time of the first accepted post in feed order;
    unchanged when the feed accepted nothing.  ``state`` has (source, last_time).

    With ``pull`` (the landed page column), the first accepted post of every pull
    is taken in its own order, and the newest of those per source wins - for a
    single pull exactly the original rule.
    """
    if pull is None:
        firsts = (accepted.groupBy("source")
                  .agg(F.min_by(F.col(time_col), order).alias("_new")))
    else:
        firsts = (accepted.groupBy("source", pull)
                  .agg(F.min_by(F.col(time_col), order).alias("_first"))
                  .groupBy("source").agg(F.max("_first").alias("_new")))
    return (state.join(firsts, "source", "left")  # a row per source: broadcast by Spark if small
            .select("source", "last_time",
                    F.coalesce("_new", "last_time").alias("new_time")))

"""The extract job end to end, over landed JSON: feed pages -> accepted posts ->
matched catalogue track -> enriched lake rows -> lake partition -> new state.

``post_rules``       F2-F6, N1-N5, P7 (stateless; also used inside the stream)
``accepted_posts``   F1 + post_rules, U1, J7 (one pass over all feeds)
``match_tracks``     A6, J3, S2, O3, J5/A4 (with S3), F10/N7, J4
``enrich``           S4, J1/J2, A7
``lake_rows``        P5: the declared 24-column lake schema
``extract_posts``    S12-S14 state in, S7 lake out (idempotent), A5 + S13 state after the data;
                     the body of a scheduled run and of each streaming micro-batch
``run_extract``      one scheduled run over the landed pages
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.fixed import CANDIDATES_PER_POST, LAKE_COLUMNS, MATCH_THRESHOLD
from cadenza.functions.text import html_unescape, is_media_link, permalink
from cadenza.functions.titles import has_separator, remove_tags, search_text, title_parts, truncate_title
from cadenza.operators.enrich import attach_features, track_artists
from cadenza.operators.feeds import advance_watermark, attach_rules, flair_passes, take_while
from cadenza.operators.matching import first_match, score_candidates, validation_pairs
from cadenza.sources import landed as L
from cadenza.sources import lake as LK
from cadenza.sources import state as ST
from cadenza.sources.missing import or_none


def feed_order() -> Column:
    """Order of a post in the landed listings: the page (one pull) and its position in it."""
    return F.struct(F.col("page").alias("g"), F.col("pos").alias("p"))


def post_rules(newer: DataFrame) -> DataFrame:
    """F2-F6 + N1-N5 + P7 on posts already carrying their rules row: flair rule, media
    link, HTML unescape, separator check, tag removal, truncation, parts, search text,
    permalink.  All stateless, so the same chain runs in batch and in a stream."""
    kept = (newer.where(flair_passes(F.col("flair"), F.col("flair_rule"), F.col("flair_values")))
            .where(is_media_link(F.col("url")))
            .withColumn("post_title", html_unescape(F.col("title")))
            .where(has_separator(F.col("post_title"))))
    trunc = truncate_title(remove_tags(F.col("post_title"), F.col("tags")))
    p0, p1 = title_parts(F.col("truncated"))
    return (kept.withColumn("truncated", trunc)
            .withColumns({"part0": p0, "part1": p1, "searching_context": search_text(F.col("truncated")),
                          "post_url": permalink(F.col("permalink_prefix"), F.col("post_id"))}))


def accepted_posts(posts: DataFrame, rules: DataFrame, marks: DataFrame,
                   mode: str = "takewhile") -> DataFrame:
    """Posts newer than their feed's mark, passing the flair rule, linking to a media
    host and titled 'artist - song'; cleaned.

    ``mode='takewhile'`` (the original): walk each pulled page in position order
    (newest first) and stop at the first post not newer than the mark, even if
    later ones are newer - per page, because each landed page is one pull;
    ``mode='filter'``: keep every newer post (equal on a sorted feed).
    """
    p = attach_rules(posts, rules).join(F.broadcast(marks), "source")
    newer_than_mark = F.col("created") > F.col("last_time")
    if mode == "filter":
        newer = p.where(newer_than_mark)
    else:
        # one stop point per (feed, page): bounded by the landed pages of the run
        newer = take_while(p, ["source", "page"], F.col("pos"), newer_than_mark,
                           broadcast_stops=False)
    return (post_rules(newer).withColumn("_order", feed_order())
            .select("source", "ord", "page", "pos", "post_id", "post_title", "created_utc", "created",
                    "post_url", "searching_context", "part0", "part1", "_order", "last_time"))


def match_tracks(posts: DataFrame, search: DataFrame, artist_dim: DataFrame,
                 k: int = CANDIDATES_PER_POST, threshold: float = MATCH_THRESHOLD,
                 cands: DataFrame | None = None) -> DataFrame:
    """First of the top-k search candidates whose name and joined artists both hit a title part.

    ``cands`` may pass already parsed candidates (``search_candidates(search, k)``).
    """
    pairs = validation_pairs(posts.withColumnRenamed("post_title", "title"), "title",
                             F.struct("ord", "_order"))
    looked = (posts.drop("part0", "part1")
              .join(pairs.withColumnRenamed("title", "post_title"), "post_title"))
    cands = cands if cands is not None else L.search_candidates(search, k)
    # artists of every distinct candidate track, joined in artist order
    ta = (cands.select("track_id", F.posexplode("artists").alias("artist_pos", "a"))
          .groupBy("track_id", "artist_pos").agg(F.max("a").alias("a"))  # one per place, however often it landed
          .select("track_id", "artist_pos", F.col("a.id").alias("artist_id"), F.col("a.name").alias("artist_name")))
    per_track = track_artists(ta, artist_dim, "track_id")
    c = (looked.join(cands.drop("artists"), "post_id")
         .join(per_track, "track_id", "left")
         .withColumn("artists_name", F.coalesce("artists_name", F.lit(""))))
    return first_match(score_candidates(c, threshold), "post_id",
                       [x for x in c.columns if x != "post_id"] + ["track_score", "artist_score"])


def enrich(matches: DataFrame, features: DataFrame, how: str = "left") -> DataFrame:
    f = L.audio_features(features)
    order = F.struct(*[F.col(n) for n, _ in L.AUDIO_FIELDS])
    return attach_features(matches, f, "track_id", order, how)


def lake_rows(df: DataFrame) -> DataFrame:
    """The declared lake schema (P5), ``mode`` kept as text; a track without any
    artist genre stores null genres (never the text of a missing value)."""
    df = df.withColumn("genres", F.nullif(F.col("genres"), F.lit("")))
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in LAKE_COLUMNS])


def _existing_post_ids(spark: SparkSession, lake_path: str, since: str) -> DataFrame | None:
    found = or_none(lambda: LK.read_lake(spark, lake_path))
    if found is None:
        return None
    return LK.since(found, since).select("post_id").distinct()


def oldest_date(marks: DataFrame, run_date: str) -> str:
    """The date of the oldest mark (the run date without one).  A post newer than its mark, and the
    lookups made for it, landed on that date or later."""
    oldest = marks.agg(F.min("last_time")).first()[0]
    return min(run_date, oldest.date().isoformat()) if oldest is not None else run_date


def run_marks(spark: SparkSession, rules: DataFrame, state_path: str, run_date: str) -> DataFrame:
    """Each feed's mark from the state table, midnight of the run date where it has none."""
    return ST.marks_with_default(rules, ST.latest_marks(ST.read_state(spark, state_path)), run_date)


def extract_posts(spark: SparkSession, posts: DataFrame, landing: str, rules: DataFrame,
                  state_path: str, lake_path: str, run_ts: _dt.datetime,
                  mode: str = "takewhile", marks: DataFrame | None = None) -> DataFrame | None:
    """The extract work for one set of parsed posts (a scheduled run, or one
    micro-batch of a stream): marks from the state table, accepted posts,
    matching and enrichment against the landed lookups, idempotent lake append,
    then the state commit.  With ``marks`` given, nothing is committed and the new
    marks are returned.

    The parsed posts, the accepted posts and the parsed candidates are each
    used by several branches of the plan (stop points, validation pairs,
    candidate join, watermark), so they are persisted for the run (memory and
    disk; a lost executor's blocks are recomputed from the landed files).
    """
    from pyspark import StorageLevel
    keep = StorageLevel.MEMORY_AND_DISK
    run_date = run_ts.date().isoformat()
    own_marks = marks is None
    if own_marks:
        marks = run_marks(spark, rules, state_path, run_date)
    # a crash before the state commit leaves rows of any date since the oldest mark
    since = oldest_date(marks, run_date)
    posts = posts.persist(keep)
    accepted = accepted_posts(posts, rules, marks, mode).persist(keep)
    search = L.landed(spark, L.SEARCH_SCHEMA, f"{landing}/search", since)
    search = search.join(accepted.select("post_id").distinct(), "post_id", "left_semi")
    cands = L.search_candidates(search, CANDIDATES_PER_POST).persist(keep)
    artists = L.artist_genres(L.landed(spark, L.ARTISTS_SCHEMA, f"{landing}/artists", since))
    features = L.landed(spark, L.AUDIO_SCHEMA, f"{landing}/features", since)
    try:
        rows = lake_rows(enrich(match_tracks(accepted, search, artists, cands=cands), features)
                         .withColumnRenamed("created_utc", "post_created_utc"))
        # a retried run (crash after the data write, before the state commit) must not
        # append its posts twice: skip posts already in the day's partition
        existing = _existing_post_ids(spark, lake_path, since)
        if existing is not None:
            rows = rows.join(existing, "post_id", "left_anti")
        LK.write_lake(LK.with_run_date(rows, run_date), lake_path)
        if mode == "filter":  # every newer post kept: the newest accepted one is the mark
            new_marks = advance_watermark(accepted, marks.select("source", "last_time"),
                                          -F.unix_micros(F.col("created").cast("timestamp")))
        else:  # first accepted post of each pull, the newest of those per feed
            new_marks = advance_watermark(accepted, marks.select("source", "last_time"),
                                          F.col("pos"), pull="page")
        if not own_marks:  # the caller commits (one row per feed)
            rows = new_marks.select("source", "new_time")
            return spark.createDataFrame(rows.collect(), rows.schema)
        ST.commit_state(new_marks, state_path, run_ts.replace(tzinfo=None))
        return None
    finally:
        for df in (cands, accepted, posts):
            df.unpersist()


def run_extract(spark: SparkSession, landing: str, rules: DataFrame, state_path: str,
                lake_path: str, run_ts: _dt.datetime, mode: str = "takewhile") -> DataFrame:
    """One scheduled run over the pages landed since the oldest mark; returns the committed
    marks.  Data is written before state."""
    run_date = run_ts.date().isoformat()
    since = oldest_date(run_marks(spark, rules, state_path, run_date), run_date)
    posts = L.read_feed_pages(spark, f"{landing}/pages", since)
    extract_posts(spark, posts, landing, rules, state_path, lake_path, run_ts, mode)
    return spark.read.parquet(state_path).where(
        F.col("committed_at") == F.lit(run_ts.replace(tzinfo=None)).cast("timestamp_ntz")
    ).select("source", F.col("last_time").alias("new_time"))

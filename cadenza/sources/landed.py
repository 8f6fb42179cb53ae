"""Landed JSON responses read with declared schemas (no inference).

* feed pages (S1): ``{"data": {"children": [{"data": {id, title, url, created_utc,
  link_flair_text}}]}}``, newest first; the feed name is the ``source=`` folder;
* search results (S2): ``{"post_id", "tracks": {"items": [{id, name, popularity,
  album: {release_date}, artists: [{id, name}]}]}}``, rank = position;
* artists (S3): ``{"artists": [{"id", "genres": [...]}]}``;
* audio features (S4): ``{"track_id", "audio_features": [{13 fields}]}``, null
  entries are skipped.

Responses land under ``run_date=<yyyy-mm-dd>/`` folders of the run that fetched them;
``landed(since=...)`` reads only the folders of that date and later.  A folder without
run dates is read whole.  One folder must not mix both forms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions.dates import epoch_to_text, text_to_ts

POST = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()), T.StructField("created_utc", T.DoubleType()),
    T.StructField("link_flair_text", T.StringType())])

FEED_SCHEMA = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("children", T.ArrayType(T.StructType([T.StructField("data", POST)])))])),
    T.StructField("source", T.StringType())])

ARTIST_REF = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])
TRACK = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("popularity", T.IntegerType()),
    T.StructField("album", T.StructType([T.StructField("release_date", T.StringType())])),
    T.StructField("artists", T.ArrayType(ARTIST_REF))])
SEARCH_SCHEMA = T.StructType([
    T.StructField("post_id", T.StringType()),
    T.StructField("tracks", T.StructType([T.StructField("items", T.ArrayType(TRACK))]))])

ARTISTS_SCHEMA = T.StructType([T.StructField("artists", T.ArrayType(T.StructType([
    T.StructField("id", T.StringType()), T.StructField("genres", T.ArrayType(T.StringType()))])))])

AUDIO_FIELDS = [("danceability", T.FloatType()), ("energy", T.FloatType()), ("key", T.IntegerType()),
                ("loudness", T.FloatType()), ("mode", T.IntegerType()), ("speechiness", T.FloatType()),
                ("acousticness", T.FloatType()), ("instrumentalness", T.FloatType()),
                ("liveness", T.FloatType()), ("valence", T.FloatType()), ("tempo", T.FloatType()),
                ("duration_ms", T.IntegerType()), ("time_signature", T.IntegerType())]
AUDIO_SCHEMA = T.StructType([
    T.StructField("track_id", T.StringType()),
    T.StructField("audio_features", T.ArrayType(T.StructType(
        [T.StructField(n, t) for n, t in AUDIO_FIELDS])))])


def landed(spark: SparkSession, schema: T.StructType, path: str, since: str | None = None) -> DataFrame:
    """Landed JSON of ``schema``; ``since`` prunes older ``run_date`` folders (a partition filter)."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("run_date", T.StringType())])).json(path)
    if since is not None:
        rows = rows.where(F.col("run_date").isNull() | (F.col("run_date") >= since))
    return rows.drop("run_date")


def feed_posts(pages: DataFrame, page_id=None) -> DataFrame:
    """S1 + P6 + N10/N11: one row per post with its page (one pull) and its position in
    the page (0 = newest).  ``page_id`` names each page row; the default is the file,
    which is enough when every file holds one pull."""
    page = page_id if page_id is not None else F.input_file_name()
    # the page id is fixed per page row before the explode (not per post)
    return (pages.select("source", page.alias("page"), "data")
            .select("source", "page", F.posexplode("data.children").alias("pos", "child"))
            .select("source", "page", "pos",
                    F.col("child.data.id").alias("post_id"),
                    F.col("child.data.title").alias("title"),
                    F.col("child.data.url").alias("url"),
                    F.col("child.data.link_flair_text").alias("flair"),
                    epoch_to_text(F.col("child.data.created_utc")).alias("created_utc"))
            .withColumn("created", text_to_ts(F.col("created_utc")).cast("timestamp_ntz")))


def pages_while(pages: DataFrame, last_time: str = "last_time") -> DataFrame:
    """F1 inside a page: its posts in page order up to (not including) the first that is not newer
    than ``last_time``.  A page is one pull and one row, so this needs no state and no shuffle and works the
    same in a stream, however its files fall into micro-batches."""
    created = lambda c: text_to_ts(epoch_to_text(c["data"]["created_utc"])).cast("timestamp_ntz")
    newer = F.transform("data.children", lambda c: F.coalesce(created(c) > F.col(last_time), F.lit(False)))
    stop = F.array_position(newer, False).cast("int")
    kept = F.when(stop > 0, F.slice("data.children", F.lit(1), stop - 1)).otherwise(F.col("data.children"))
    return pages.withColumn("data", F.struct(kept.alias("children")))


def read_feed_pages(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """S1 batch: landed pages under ``path[/run_date=<date>]/source=<feed>/``; a file may hold
    several pages (JSON lines), so each page line gets its own id (file + row id)."""
    page_id = F.concat(F.input_file_name(), F.lit("#"),
                       F.monotonically_increasing_id().cast("string"))
    return feed_posts(landed(spark, FEED_SCHEMA, path, since), page_id)


def search_candidates(search: DataFrame, k: int | None = None) -> DataFrame:
    """S2 + P6 + O3: ranked candidates per post (``cand_rank`` from 1), artists kept in order."""
    c = (search.select("post_id", F.posexplode("tracks.items").alias("pos", "t"))
         .select("post_id", (F.col("pos") + 1).alias("cand_rank"),
                 F.col("t.id").alias("track_id"), F.col("t.name").alias("track_name"),
                 F.col("t.popularity").alias("track_popularity"),
                 F.col("t.album.release_date").alias("release_date"),
                 F.col("t.artists").alias("artists")))
    if k is not None:
        c = c.where(F.col("cand_rank") <= k)
    return c


def artist_genres(artists: DataFrame) -> DataFrame:
    """S3: artist id -> genre list (order kept)."""
    return (artists.select(F.explode("artists").alias("a"))
            .select(F.col("a.id").alias("artist_id"),
                    F.coalesce(F.col("a.genres"), F.array().cast("array<string>")).alias("genres")))


def audio_features(features: DataFrame) -> DataFrame:
    """``inline`` the feature structs; null entries are dropped instead of failing."""
    return (features.select("track_id", F.explode("audio_features").alias("f"))
            .where(F.col("f").isNotNull())
            .select("track_id", *[F.col(f"f.{n}").alias(n) for n, _ in AUDIO_FIELDS]))

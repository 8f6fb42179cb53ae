"""Enrichment: J5 / A4 / N17 (artists and genres of a track) and J1 / J2 / A7 (features).

``attach_features`` keeps the first feature row per key *before* joining, which
gives the same rows as "left join, then drop duplicate post ids" without ever
materialising the fan-out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.operators.ranking import first_per_group


def track_artists(track_artists_df: DataFrame, artists: DataFrame,
                  track: str = "track_id") -> DataFrame:
    """J5 + A4 + N17: per track, artist ids, names (',' -> ' ') and genres, in artist order.

    ``track_artists_df``: (track, artist_pos, artist_id); ``artists``: (artist_id,
    artist_name, genres array<string>).  The groups are one track's artists
    (a handful), so the ordered ``collect_list`` is bounded.
    """
    # one row per artist, however often its response landed
    others = [c for c in artists.columns if c != "artist_id"]
    artists = artists.groupBy("artist_id").agg(F.max(F.struct(*others)).alias("_x")).select("artist_id", "_x.*")
    j = track_artists_df.join(artists, "artist_id", "left")
    rec = F.struct(F.col("artist_pos").alias("p"), F.col("artist_id").alias("k"),  # ties: by id
                   F.col("artist_id").cast("string").alias("id"),
                   F.replace(F.col("artist_name"), F.lit(","), F.lit(" ")).alias("name"),
                   F.coalesce("genres", F.array().cast("array<string>")).alias("genres"))
    agg = j.groupBy(track).agg(F.array_sort(F.collect_list(rec)).alias("_a"))
    return agg.select(
        track,
        F.array_join(F.transform("_a", lambda x: x["id"]), ", ").alias("artists_id"),
        F.array_join(F.transform("_a", lambda x: x["name"]), ", ").alias("artists_name"),
        F.array_join(F.flatten(F.transform("_a", lambda x: x["genres"])), ", ").alias("genres"))


def attach_features(matches: DataFrame, features: DataFrame, key: str,
                    order: Column, how: str = "left") -> DataFrame:
    """J1 (left, default) / J2 (inner) + A7: one feature row per key, first in ``order``."""
    cols = [c for c in features.columns if c != key]
    one = first_per_group(features.withColumn("_fo", order), [key], F.col("_fo"), cols)
    return matches.join(one, key, how)

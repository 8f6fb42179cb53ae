"""The daily per-genre report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.fixed import AVG_COLUMNS, GENRE_LABELS, REPORT_COLUMNS
from cadenza.functions.dates import run_date_parts
from cadenza.operators.labels import label_unique


def genre_aggregate(labelled: DataFrame, label: str = "major_genre") -> DataFrame:
    """Group by label (null is a group): count, floor(avg(popularity)), round(avg, 3) x 4.

    A plain ``groupBy().agg`` so Spark runs a partial (map-side) and a final
    hash aggregate: a hot genre is combined before the shuffle.
    """
    return labelled.groupBy(F.col(label).alias("Genre")).agg(
        F.count(F.lit(1)).alias("NumberOfSongs"),
        F.floor(F.avg("track_popularity")).cast("bigint").alias("Popularity"),
        F.round(F.avg("danceability"), 3).alias("Danceability"),
        F.round(F.avg("energy"), 3).alias("Energy"),
        F.round(F.avg("valence"), 3).alias("Valence"),
        F.round(F.avg("loudness"), 3).alias("Loudness"),
    )


PARTIAL_COLUMNS = (["_n"] + [f"_s_{c}" for c in AVG_COLUMNS] + [f"_c_{c}" for c in AVG_COLUMNS])


def genre_partials(rows: DataFrame, key: str = "genres") -> DataFrame:
    """Partial sums per ``key``: row count, and sum + non-null count of each averaged
    column.  Map-side combined, so the shuffle carries one row per key and task."""
    return rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_s_{c}") for c in AVG_COLUMNS],
        *[F.count(c).alias(f"_c_{c}") for c in AVG_COLUMNS])


def combine_partials(partials: DataFrame, key: str) -> DataFrame:
    """Re-group partial sums on another key (sums of sums)."""
    return partials.groupBy(key).agg(*[F.sum(c).alias(c) for c in PARTIAL_COLUMNS])


def report_from_partials(per_list: DataFrame, run_date: str,
                         labels: list[str] = GENRE_LABELS) -> DataFrame:
    """Partial sums per genre list -> labelled -> report rows.

    Only the lists are labelled (one row each); averages are sum / non-null
    count, as AVG does (null when a group has no value).
    """
    labelled = label_unique(per_list, "genres", labels, "major_genre")
    sums = labelled.groupBy(F.col("major_genre").alias("Genre")).agg(
        F.sum("_n").alias("NumberOfSongs"),
        *[F.sum(f"_s_{c}").alias(f"_s_{c}") for c in AVG_COLUMNS],
        *[F.sum(f"_c_{c}").alias(f"_c_{c}") for c in AVG_COLUMNS])
    avg = {c: F.try_divide(F.col(f"_s_{c}"), F.col(f"_c_{c}")) for c in AVG_COLUMNS}
    y, m, d = run_date_parts(run_date)
    return sums.select(
        "Genre", "NumberOfSongs",
        F.floor(avg["track_popularity"]).cast("bigint").alias("Popularity"),
        *[F.round(avg[c], 3).alias(AVG_COLUMNS[c]) for c in AVG_COLUMNS if c != "track_popularity"],
        F.lit(y).alias("year"), F.lit(m).alias("month"), F.lit(d).alias("day")
    ).select(*REPORT_COLUMNS)


def daily_genre_report(lake_day: DataFrame, run_date: str,
                       labels: list[str] = GENRE_LABELS) -> DataFrame:
    """One day of lake rows -> report rows with the run date as zero-padded strings.

    One pass over the lake: rows are first reduced to partial sums per genre
    list, only those few lists are labelled, and the partial sums are
    combined per label.
    """
    return report_from_partials(genre_partials(lake_day, "genres"), run_date, labels)


def genre_report_sql(spark, lake_day: DataFrame, run_date: str,
                     labels: list[str] = GENRE_LABELS, view: str = "spotify") -> DataFrame:
    """The same report written as SQL over a registered temp view.

    The view holds the labelled partial sums per genre list (one lake scan), so
    the SQL combines sums and non-null counts; ``try_divide`` keeps AVG's null
    for a group without values.
    """
    label_unique(genre_partials(lake_day, "genres"), "genres", labels,
                 "major_genre").createOrReplaceTempView(view)
    y, m, d = run_date_parts(run_date)
    return spark.sql(f"""
        SELECT major_genre AS Genre,
               SUM(_n) AS NumberOfSongs,
               CAST(FLOOR(try_divide(SUM(_s_track_popularity), SUM(_c_track_popularity))) AS BIGINT)
                 AS Popularity,
               ROUND(try_divide(SUM(_s_danceability), SUM(_c_danceability)), 3) AS Danceability,
               ROUND(try_divide(SUM(_s_energy), SUM(_c_energy)), 3) AS Energy,
               ROUND(try_divide(SUM(_s_valence), SUM(_c_valence)), 3) AS Valence,
               ROUND(try_divide(SUM(_s_loudness), SUM(_c_loudness)), 3) AS Loudness,
               '{y}' AS year, '{m}' AS month, '{d}' AS day
        FROM {view}
        GROUP BY major_genre""")

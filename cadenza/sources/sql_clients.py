"""X1 / S16 for SQL clients: the label as a SQL function, the lake and the report as views.

After ``publish``, plain SQL is enough: ``SELECT major_genre(genres) ...`` and
``SELECT * FROM genre_report_by_day``.  The report view first sums per genre list, so the
function runs once per distinct list, and its aggregates are Spark's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadenza.fixed import GENRE_LABELS
from cadenza.operators.labels import major_genre_udf

FUNCTION, LAKE_VIEW, REPORT_VIEW = "major_genre", "lake", "genre_report_by_day"
_SUMMED = ["track_popularity", "danceability", "energy", "valence", "loudness"]


def report_view_sql(lake: str = LAKE_VIEW) -> str:
    sums = ", ".join(f"SUM({c}) AS s_{c}, COUNT({c}) AS c_{c}" for c in _SUMMED)
    avg = {c: f"try_divide(SUM(s_{c}), SUM(c_{c}))" for c in _SUMMED}
    return f"""
        SELECT major_genre(genres) AS Genre, SUM(n) AS NumberOfSongs,
               CAST(FLOOR({avg['track_popularity']}) AS BIGINT) AS Popularity,
               ROUND({avg['danceability']}, 3) AS Danceability, ROUND({avg['energy']}, 3) AS Energy,
               ROUND({avg['valence']}, 3) AS Valence, ROUND({avg['loudness']}, 3) AS Loudness, year, month, day
        FROM (SELECT genres, year, month, day, COUNT(*) AS n, {sums} FROM {lake} GROUP BY genres, year, month, day)
        GROUP BY 1, year, month, day"""


def publish(spark: SparkSession, lake: DataFrame, labels: list[str] = GENRE_LABELS) -> None:
    """Register the function and the views for this session; ``lake`` has ``year, month, day``."""
    spark.udf.register(FUNCTION, major_genre_udf(labels))
    lake.createOrReplaceTempView(LAKE_VIEW)
    spark.sql(report_view_sql()).createOrReplaceTempView(REPORT_VIEW)

"""N16 / J6 / N6 kept between runs: a dictionary of scored genre tokens.

A token's similarity to each vocabulary label never changes, so it is scored once in the life of the
dictionary: a run scores the distinct tokens that the stored table does not hold (an anti-join),
appends them, and labels all lists from the table.  The sums are added in token order, so the
labels equal those of ``labels.with_major_genre`` bit for bit.

The table is Parquet under ``<path>/vocabulary=<hash>``: another vocabulary starts a dictionary of its own.
A run that fails before its append leaves the table as it was; the next one scores those tokens again.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.fixed import GENRE_LABELS
from cadenza.functions.similarity import label_sums_udf
from cadenza.operators.labels import _label_of, genre_tokens
from cadenza.sources.missing import or_none

DICTIONARY = "token string, scores array<double>"


def _folder(path: str, labels: list[str]) -> str:
    return f"{path.rstrip('/')}/vocabulary={sha256(chr(0).join(labels).encode()).hexdigest()[:16]}"


def read_dictionary(spark: SparkSession, path: str, labels: list[str] = GENRE_LABELS) -> DataFrame:
    """``token, scores``; empty before the first run.  Two runs at a time may both store a token: one copy counts."""
    at = _folder(path, labels)
    stored = or_none(lambda: spark.read.schema(DICTIONARY).parquet(at))
    return spark.createDataFrame([], DICTIONARY) if stored is None else stored.dropDuplicates(["token"])


def learn_tokens(lists: DataFrame, path: str, col: str = "genres", labels: list[str] = GENRE_LABELS) -> int:
    """Score and append the tokens of ``lists[col]`` that the dictionary lacks; how many there were."""
    spark = lists.sparkSession
    tokens = lists.where(F.col(col).isNotNull()).select(F.explode(genre_tokens(F.col(col))).alias("token")).distinct()
    known = read_dictionary(spark, path, labels).select("token")
    before = known.count()
    fresh = tokens.join(known, "token", "left_anti")
    fresh.select("token", label_sums_udf(labels)(F.array("token")).alias("scores")).write.mode("append").parquet(_folder(path, labels))
    return read_dictionary(spark, path, labels).count() - before


def label_from_dictionary(df: DataFrame, path: str, col: str = "genres", out: str = "major_genre",
                          labels: list[str] = GENRE_LABELS) -> DataFrame:
    """Add ``out``, the major label of ``df[col]`` (null stays null), from stored scores alone.

    Distinct lists meet the dictionary by token; a list's rows come together only as its own tokens.
    """
    stored = read_dictionary(df.sparkSession, path, labels)
    lists = df.select(F.col(col).alias("_list")).where("_list is not null").distinct()
    tokens = lists.select("_list", F.posexplode(genre_tokens(F.col("_list"))).alias("_pos", "token"))
    scored = (tokens.join(stored, "token").groupBy("_list")
              .agg(F.array_sort(F.collect_list(F.struct("_pos", "scores"))).alias("_scored")))
    zero = F.array(*[F.lit(0.0)] * len(labels))
    sums = F.aggregate("_scored", zero, lambda acc, x: F.zip_with(acc, x["scores"], lambda a, b: a + b))
    named = scored.select("_list", _label_of(sums, labels).alias(out))
    return df.join(named, F.col(col) == F.col("_list"), "left").drop("_list")


def label_incremental(df: DataFrame, path: str, col: str = "genres", out: str = "major_genre",
                      labels: list[str] = GENRE_LABELS) -> tuple[DataFrame, int]:
    """Learn what is new, then label; the labelled rows and the number of tokens scored."""
    scored = learn_tokens(df, path, col, labels)
    return label_from_dictionary(df, path, col, out, labels), scored

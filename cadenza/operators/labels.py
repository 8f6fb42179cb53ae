"""Major genre of a free-form genre list.

Rule: split the list on ``', '``, remove spaces from each token, add up the
similarity of every vocabulary label to every token *in token order*, and
take the label with the highest sum; ties go to the earlier label.  A null
list gives null; an empty string gives the first label.

Spark-first plan (no per-row Python):

1. the label is a function of the list text, so only *distinct* lists are
   classified (partial aggregation map-side, so a hot list costs nothing);
2. each distinct list's tokens go to one Arrow call that returns the 20 ordered
   sums; each distinct token of a batch is scored once (vocabulary x token is a
   loop inside the helper, not a join), and nothing is regrouped;
3. the arg-max is ``array_position`` of ``array_max`` (first maximum = earliest label);
4. the small list -> label map is joined back to the rows; AQE broadcasts it
   when its measured size is under the broadcast threshold and falls back to a
   shuffle join (with skew splitting) otherwise.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.fixed import GENRE_LABELS
from cadenza.functions.similarity import label_sums, label_sums_udf


def genre_tokens(genres: Column) -> Column:
    """The scored tokens of a genre list (split on ', ', spaces removed)."""
    return F.transform(F.split(genres, ", ", -1), lambda t: F.translate(t, " ", ""))


def _label_of(sums: Column, labels: list[str]) -> Column:
    # ``get`` passes a null index on (``element_at`` over literals would return the last label)
    vocab = F.array(*[F.lit(x) for x in labels])
    return F.get(vocab, F.array_position(sums, F.array_max(sums)).cast("int") - 1)


def label_unique(df: DataFrame, col: str = "genres", labels: list[str] = GENRE_LABELS,
                 out: str = "major_genre") -> DataFrame:
    """Label a frame holding each list at most once (e.g. the output of a
    ``groupBy(col)``), keeping its other columns; null list -> null label.  No shuffle."""
    keep = [c for c in df.columns if c != col]
    return (df.withColumn("label_scores", label_sums_udf(labels)(genre_tokens(F.col(col))))
            .withColumn(out, _label_of(F.col("label_scores"), labels))
            .select(col, *keep, out, "label_scores"))


def label_map(lists: DataFrame, col: str = "genres",
              labels: list[str] = GENRE_LABELS, out: str = "major_genre") -> DataFrame:
    """Distinct genre lists of ``lists[col]`` -> their major label.

    Returns columns ``(col, out, label_scores)``; ``label_scores`` is the per-label
    sum, in vocabulary order.
    """
    distinct_lists = lists.select(col).where(F.col(col).isNotNull()).distinct()
    return label_unique(distinct_lists, col, labels, out)


def with_major_genre(df: DataFrame, col: str = "genres", out: str = "major_genre",
                     labels: list[str] = GENRE_LABELS) -> DataFrame:
    """Add ``out`` = major label of ``df[col]`` (null stays null)."""
    m = label_map(df, col, labels, out).select(F.col(col).alias("_lk"), out)
    return df.join(m, df[col] == m["_lk"], "left").drop("_lk")


def major_genre_udf(labels: list[str] = GENRE_LABELS):
    """X1 as a drop-in column function, ``major_genre_udf()(col)``, for ad-hoc use.

    The same helper and rule; ``with_major_genre`` is the plan to use on large frames: it
    labels each distinct list once across the whole job.
    """
    vocab = list(labels)

    @F.pandas_udf("string")
    def label(genres: pd.Series) -> pd.Series:
        tokens = [None if g is None else [t.replace(" ", "") for t in g.split(", ")] for g in genres]
        return pd.Series([None if s is None else vocab[s.index(max(s))] for s in label_sums(tokens, vocab)], dtype="object")

    return label

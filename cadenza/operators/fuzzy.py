"""J8 without shared words: every pair of texts within an edit-distance rate, by a q-gram inverted index.

Two strings whose edit distance is at most ``floor(rate * longer length)`` share many of their
padded bigrams: an edit destroys two at most, so of the longer string's ``m + 1`` bigrams at least
``m + 1 - 2 floor(rate m)`` are shared (positive for every length while ``rate`` is under one half).
That gives, all in Catalyst expressions:

* a prefix index: with bigrams in one order from rare to frequent, two such strings share one among
  the rarest of each, so only those are filed and looked up;
* a length and a count filter on the pairs that met;
* ``levenshtein`` with its threshold on what is left.

No pair is lost and none is compared that shares no rare bigram: an equi-join on (block, bigram), no
cartesian product.  Strings are compared lower-cased; null strings match nothing, two empty
ones match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Edits per character of the longer string.
MAX_RATE = 0.3
#: Marks the two ends of a string; never part of one.
_END = "\u0001"


def edits_allowed(m: Column, rate: float = MAX_RATE) -> Column:
    """Most edits between strings whose longer one has ``m`` characters."""
    return F.floor(m * F.lit(rate) + F.lit(1e-9)).cast("int")


def bigrams(text: Column) -> Column:
    """Padded bigrams of a string as a set: the n-th occurrence of one is told apart from the others."""
    padded = F.concat(F.lit(_END), text, F.lit(_END))
    grams = F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substring(padded, i, F.lit(2)))
    # sorted, so that equal bigrams stand together; their place from the first one on tells them apart
    ordered = F.array_sort(grams)
    return F.transform(ordered, lambda g, i: F.concat(g, (i + 1 - F.array_position(ordered, g)).cast("string")))


def least_shared(m: Column, rate: float = MAX_RATE) -> Column:
    """Fewest bigrams that such strings share, if the longer one has ``m`` characters."""
    return m + 1 - 2 * edits_allowed(m, rate)


def _prefix_length(n: Column, rate: float) -> Column:
    """How many of the rarest bigrams of a string of ``n`` characters must be filed: the partner may be
    longer (up to ``n / (1 - rate)``), which can lower the number shared by one step of the floor."""
    longest = F.floor(n / F.lit(1.0 - rate)).cast("int") + 1
    least = F.array_min(F.transform(F.sequence(n, longest), lambda m: least_shared(m, rate)))
    return F.greatest(F.lit(1), n + 2 - least)


def _described(strings: DataFrame, block: str, text: str, side: int) -> DataFrame:
    return (strings.where(F.col(text).isNotNull()).select(F.col(block).alias("block"), F.lower(text).alias("text")).distinct()
            .select("block", "text", F.lit(side).alias("side"), F.length("text").alias("n"), bigrams(F.col("text")).alias("grams")))


def fuzzy_pairs(left: DataFrame, right: DataFrame, block: str = "block", left_text: str = "part0",
                right_text: str = "track_name", rate: float = MAX_RATE) -> DataFrame:
    """``block, left_key, right_key, distance``: all distinct lower-cased strings of a block within the rate."""
    if not 0 <= rate < 0.5:
        raise ValueError("the count filter needs a rate under one half")
    both = _described(left, block, left_text, 0).union(_described(right, block, right_text, 1))
    # no string is without bigrams; of an inner explode Spark infers a filter on them, which it would move below
    # the distinct: bigrams of every row that was read, not of every string
    filed = both.select("block", "side", "text", "n", "grams", F.explode_outer("grams").alias("gram"))
    often = both.select("block", F.explode_outer("grams").alias("gram")).groupBy("block", "gram").agg(F.count(F.lit(1)).alias("often"))
    ranked = (filed.select("block", "side", "text", "n", "gram").join(often, ["block", "gram"])
              .groupBy("block", "side", "text", "n")
              .agg(F.array_sort(F.collect_list(F.struct("often", "gram"))).alias("by_rarity")))  # one string's bigrams
    prefix = ranked.select("block", "side", "text", "n", F.transform("by_rarity", lambda x: x["gram"]).alias("grams"),
                           F.explode(F.slice("by_rarity", F.lit(1), _prefix_length(F.col("n"), rate))).alias("x"))
    prefix = prefix.select("block", "side", "text", "n", "grams", F.col("x.gram").alias("gram"))
    asked = prefix.where("side = 0").select("block", "gram", F.col("text").alias("left_key"), F.col("n").alias("_ln"), F.col("grams").alias("_lg"))
    found = prefix.where("side = 1").select("block", "gram", F.col("text").alias("right_key"), F.col("n").alias("_rn"), F.col("grams").alias("_rg"))
    longer = F.greatest("_ln", "_rn")
    met = (asked.join(found, ["block", "gram"])
           .where((longer - F.least("_ln", "_rn") <= edits_allowed(longer, rate))
                  & (F.size(F.array_intersect("_lg", "_rg")) >= least_shared(longer, rate)))
           .select("block", "left_key", "right_key", longer.alias("_m")).distinct())
    distance = F.levenshtein("left_key", "right_key")
    return (met.withColumn("distance", distance).where(F.col("distance") <= edits_allowed(F.col("_m"), rate))
            .select("block", "left_key", "right_key", "distance"))

"""Post -> catalogue matching: A6 / W1 / J3 / J8 / O3 / J4 / F10 / N7.

Plan:

* ``validation_pairs``: one (part0, part1) per raw title, the first in feed
  order (A6), as a ``min_by`` aggregate;
* ``repeat_numbers``: n of the n-th repeat in feeds 2-4 (W1), via a scalable global
  row number; ``dedup_keys`` renders it as the original's keys, a title plus n dots;
* ``block_candidates``: distinct texts and track names meet on shared words of
  their block (J8), or within an edit distance; the k best per text, by shared words,
  fewest other words, then catalogue rank (O3), are the post's candidates;
* ``score_candidates``: F10/N7 per candidate row with one Arrow helper that
  skips ``ratio`` when difflib's cheap upper bounds already rule a hit out and
  memoises repeated pairs inside the batch - no shuffle;
* ``first_match``: lowest-rank accepted candidate per post (J4), ``min_by``.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.fixed import CANDIDATES_PER_POST, MATCH_THRESHOLD
from cadenza.operators.fuzzy import fuzzy_pairs
from cadenza.operators.ranking import first_per_group, global_row_number, top_k_per_group

SCORE_TYPE = T.StructType([T.StructField("track_score", T.DoubleType()),
                           T.StructField("artist_score", T.DoubleType())])


def validation_pairs(posts: DataFrame, title: str = "title",
                     order: Column | None = None) -> DataFrame:
    """Raw title -> (part0, part1) of its first post in feed order."""
    order = order if order is not None else F.struct("ord", "pos")
    return first_per_group(posts.withColumn("_o", order), [title], F.col("_o"),
                           ["part0", "part1"])


def repeat_numbers(posts: DataFrame, title: str = "title") -> DataFrame:
    """W1 as numbers: ``is_repeat`` and ``repeat_no``, the n of the n-th repeat (n shared by
    feeds 2-4, never reset), null for other posts.

    A repeat is a post of feeds 2-4 whose raw title appeared at an earlier
    (ord, pos).  Feed 1 repeats keep the bare title.
    """
    first = posts.groupBy(title).agg(F.min(F.struct("ord", "pos")).alias("_first"))
    tagged = (posts.join(first, title)
              .withColumn("is_repeat", (F.col("ord") > 1) &
                          (F.struct("ord", "pos") > F.col("_first")))
              .drop("_first"))
    reps = global_row_number(tagged.where("is_repeat"), [F.col("ord"), F.col("pos")], "repeat_no")
    rest = tagged.where(~F.col("is_repeat")).withColumn("repeat_no", F.lit(None).cast("bigint"))
    return reps.withColumn("repeat_no", F.col("repeat_no").cast("bigint")).unionByName(rest)


def dedup_keys(posts: DataFrame, title: str = "title") -> DataFrame:
    """W1 as the original's text keys: title, plus n dots for the n-th repeat.

    The dots add up to the square of the number of repeats: for small results at the
    edge only; ``repeat_numbers`` holds the same fact in eight bytes.
    """
    dots = F.repeat(F.lit("."), F.coalesce(F.col("repeat_no"), F.lit(0)).cast("int"))
    return repeat_numbers(posts, title).withColumn("key", F.concat(F.col(title), dots)).drop("repeat_no")


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), " +"), lambda t: t != ""))


def block_candidates(posts: DataFrame, catalogue: DataFrame, k: int = CANDIDATES_PER_POST,
                     block: str = "block", asked: str = "part0", fuzzy_rate: float | None = None) -> DataFrame:
    """J8 + O3: each post's ``k`` best catalogue rows of its block, whatever their place in it.

    Candidates are ranked per post: by the words that the track name shares with the
    post's ``asked`` text, then by the fewest words of the name that it does not share (an exact
    name goes before longer ones), then by ``rank_key``.  Distinct texts meet distinct names on
    (block, word), so repeated posts and names cost nothing, and the words shared are
    counted before names meet the catalogue's rows.  With ``fuzzy_rate``, names within that many
    edits per character of the text are candidates too, whatever words they share
    (``fuzzy.fuzzy_pairs``); of equal words the nearer name goes first.
    ``catalogue`` needs ``block``, ``track_id``, ``track_name``, ``artists_name``, ``rank_key``.
    """
    texts = posts.select(block, asked).distinct()
    names = catalogue.select(block, "track_name").distinct()
    near = (texts.select(block, asked, F.explode(_tokens(F.col(asked))).alias("_t"))
            .join(names.select(block, "track_name", F.explode(_tokens(F.col("track_name"))).alias("_t")), [block, "_t"])
            .groupBy(block, asked, "track_name").agg(F.count(F.lit(1)).alias("_shared")))
    order = [F.col("_shared").desc(), F.col("_unshared"), F.col("rank_key")]
    if fuzzy_rate is not None:
        pairs = fuzzy_pairs(texts, names, block, asked, "track_name", fuzzy_rate)
        close = (pairs.join(texts.withColumn("left_key", F.lower(asked)), [block, "left_key"])
                 .join(names.withColumn("right_key", F.lower("track_name")), [block, "right_key"])
                 .select(block, asked, "track_name", "distance"))
        near = near.join(close, [block, asked, "track_name"], "full").withColumn("_shared", F.coalesce("_shared", F.lit(0)))
        order.insert(2, F.col("distance").asc_nulls_last())
    near = near.withColumn("_unshared", F.size(_tokens(F.col("track_name"))) - F.col("_shared"))
    # of equal names only the first k rows can be among a post's k best
    rows = top_k_per_group(catalogue, [block, "track_name"], [F.col("rank_key")], k, "_nth").drop("_nth")
    best = top_k_per_group(near.join(rows, [block, "track_name"]), [block, asked], order, k, "cand_rank").drop("_shared", "_unshared", "distance")
    return posts.join(best, [block, asked])


def _hit_score(matcher: SequenceMatcher, a: str, parts, thr: float, memo: dict) -> float:
    """N7 for one field: over the title parts in order, the last ratio above thr (else 0)."""
    kept = 0.0
    for p in parts:
        if p is None:
            continue
        key = (a, p)
        r = memo.get(key)
        if r is None:
            matcher.set_seqs(a, p)
            # real_quick_ratio and quick_ratio are upper bounds of ratio()
            if matcher.real_quick_ratio() <= thr or matcher.quick_ratio() <= thr:
                r = -1.0  # cannot be a hit
            else:
                r = matcher.ratio()
            memo[key] = r
        if r > thr:
            kept = r
    return kept


def match_scores_udf(threshold: float = MATCH_THRESHOLD):
    @F.pandas_udf(SCORE_TYPE)
    def scores(track: pd.Series, artists: pd.Series, p0: pd.Series, p1: pd.Series) -> pd.DataFrame:
        sm = SequenceMatcher(None, "", "")
        memo: dict = {}
        ts, ars = [], []
        for t, a, x, y in zip(track, artists, p0, p1):
            parts = (x, y)
            ts.append(_hit_score(sm, t, parts, threshold, memo) if t is not None else 0.0)
            ars.append(_hit_score(sm, a, parts, threshold, memo) if a is not None else 0.0)
        return pd.DataFrame({"track_score": ts, "artist_score": ars})

    # marked non-deterministic so Catalyst never inlines the struct into both
    # field reads (which would run the helper twice)
    return scores.asNondeterministic()


def score_candidates(cands: DataFrame, threshold: float = MATCH_THRESHOLD) -> DataFrame:
    """Keep candidates whose track name and artists both hit a title part.

    Each kept score is either above the threshold or 0.
    """
    s = match_scores_udf(threshold)(F.col("track_name"), F.col("artists_name"),
                                    F.col("part0"), F.col("part1"))
    return (cands.withColumn("_s", s)
            .withColumns({"track_score": F.col("_s.track_score"),
                          "artist_score": F.col("_s.artist_score")})
            .drop("_s")
            .where((F.col("track_score") > threshold) & (F.col("artist_score") > threshold)))


def first_match(accepted: DataFrame, post_key: str = "post_id",
                cols: list[str] | None = None) -> DataFrame:
    """The accepted candidate with the lowest rank wins."""
    cols = cols or [c for c in accepted.columns if c not in (post_key,)]
    return first_per_group(accepted, [post_key], F.col("cand_rank"), cols)


def match_posts(posts: DataFrame, catalogue: DataFrame, k: int = CANDIDATES_PER_POST,
                threshold: float = MATCH_THRESHOLD, fuzzy_rate: float | None = None) -> DataFrame:
    """Cleaned posts (post_id, title, block, ord, pos, part0, part1) -> matched track per post.

    The title parts come from the first post with the same raw title (J3 over A6).  ``fuzzy_rate`` adds
    names that are only misspelt (``block_candidates``).
    """
    pairs = validation_pairs(posts)
    looked_up = posts.drop("part0", "part1").join(pairs, "title")
    # the match depends on block and parts alone: each distinct set of them meets its k candidates once, and
    # posts meet one row of it (not k)
    asked = looked_up.select("block", "part0", "part1").distinct()
    cands = block_candidates(asked, catalogue, k, fuzzy_rate=fuzzy_rate)
    found = ["track_id", "track_name", "artists_name", "cand_rank", "track_score", "artist_score"]
    best = first_per_group(score_candidates(cands, threshold), ["block", "part0", "part1"], F.col("cand_rank"), found)
    # a small file can hold many posts: by its size alone Spark would broadcast them and pair them all in a few tasks
    matched = looked_up.alias("p").join(best.hint("merge").alias("b"), (F.col("p.block") == F.col("b.block")) & (F.col("p.part0") == F.col("b.part0"))
                                        & F.col("p.part1").eqNullSafe(F.col("b.part1"))).select("p.post_id", "p.title", *found)
    return first_match(matched, "post_id", ["title", *found])

"""Mixing sources to target weights, with an exact word budget per source.

Every document gets a random key from a hash of its id.  Within a source, documents
are range-sorted by that key and their sizes (words) are added up in a distributed
prefix sum; the mix takes whole passes over the source (epochs) and then documents
in key order until the budget is used up, the last one in part.  Where a source is
cut is one row (its key, the words taken of that document), so the texts themselves
are never shuffled: each document compares its key with its source's cut.

Targets: each source's share of all words by weight, at most ``max_epochs`` times its
size; what exceeds that goes to the others by weight until none exceeds it.

Null texts and texts without words have size 0.  A null source is a source of its
own (the last).  Rows with equal id, source and text are one entry of the order
whose words they share evenly (rounded down).  An empty table gives an empty mix.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm import words as W
from cadenza.llm.shared import prefix_sums, text_key, written

MAX_EPOCHS = 3
SEED = "mix"
#: Sources whose cut rows are broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 100_000
_SIZED = ["doc_id", "source", "mix_key", "text_key", "size"]


def mix_key(seed: str = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def word_counts(column: pa.Array) -> np.ndarray:
    out = np.zeros(len(column), np.int64)
    for at, to, buf, off in W.text_blocks(column):
        out[at:to] = np.diff(W.words(buf, off, W.NOT_SPACE, lower=False, hashes=False).bounds)
    return out


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``doc_id, source, mix_key, text_key, size`` of each row."""
    def count(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.select(_SIZED[:4]).columns, pa.array(word_counts(b.column("text")), pa.int64())], names=_SIZED)

    rows = docs.select("doc_id", "source", mix_key(seed).alias("mix_key"), text_key(F.col("text")).alias("text_key"), "text")
    return rows.mapInArrow(count, "doc_id bigint, source string, mix_key string, text_key bigint, size bigint")


def default_weights(sources: DataFrame) -> DataFrame:
    """Weights 1, 2, 3, repeating, over the sources by code point, null last."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    return sources.withColumn("weight", (1 + (F.row_number().over(order) - 1) % 3).cast("bigint"))


def targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``target`` of each row ``(source, source_size, weight)``; one row per source, so these windows are small.

    Sources are taken by ``size / weight``: the first one whose share is within its
    limit, given that all before it stop at theirs, sets the rate for the rest.
    """
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    cap = F.col("source_size") * max_epochs
    s = sources.withColumn("ratio", F.col("source_size").cast("double") / F.col("weight"))
    s = s.select("*", F.sum("source_size").over(every).alias("all_size"), F.sum("weight").over(every).alias("all_weight"),
                 F.coalesce(F.sum(cap).over(before), F.lit(0)).alias("stopped"),
                 F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("gone"))
    s = (s.withColumn("left_size", (F.col("all_size") - F.col("stopped")).cast("double"))
         .withColumn("left_weight", F.col("all_weight") - F.col("gone"))
         .withColumn("within", F.col("left_size") * F.col("weight") / F.col("left_weight") <= cap))
    first = F.min(F.when(F.col("within"), F.struct("ratio", F.col("source").isNull().alias("none"), "source",
                                                   "left_size", "left_weight"))).over(every)
    s = s.withColumn("first", first)
    at = F.struct("ratio", F.col("source").isNull().alias("none"), "source")
    free = at >= F.struct("first.ratio", "first.none", "first.source")
    share = F.col("first.left_size") * F.col("weight") / F.col("first.left_weight")
    return s.select("source", "source_size", "weight",
                    F.when(F.coalesce(free, F.lit(False)), share).otherwise(cap.cast("double")).alias("target"))


def cuts(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``source, source_size, target, epochs, cut_key, cut_id, cut_text, cut_words`` of each source.

    ``rows``: as of ``sized``.  ``cut_words``: words taken of each row at the cut.
    """
    entries = (rows.groupBy("source", "mix_key", "doc_id", "text_key")
               .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("copies")))
    order = [F.col("source").asc_nulls_last(), F.col("mix_key"), F.col("doc_id"), F.col("text_key")]
    entries = prefix_sums(entries, order, "words", "before")
    starts = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    plan = planned.select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor("target") / F.col("source_size")).otherwise(0).cast("bigint").alias("epochs"),
        F.coalesce(F.sum("source_size").over(starts), F.lit(0)).alias("starts"))
    plan = plan.withColumn("rest", F.floor("target") - F.col("epochs") * F.col("source_size"))
    p = plan.alias("p")
    e = entries.alias("e")
    at = (e.join(F.broadcast(p) if planned.count() <= BROADCAST_SOURCES else p, F.expr("e.source <=> p.source"))
          .withColumn("from", F.col("before") - F.col("starts"))
          .filter("rest > from and rest <= from + words and words > 0"))
    at = at.select("p.source", F.col("mix_key").alias("cut_key"), F.col("doc_id").alias("cut_id"), F.col("text_key").alias("cut_text"),
                   F.floor((F.col("rest") - F.col("from")) / F.col("copies")).cast("bigint").alias("cut_words"))
    a = at.alias("a")
    return (p.join(a, F.expr("p.source <=> a.source"), "left")
            .select("p.source", "source_size", "target", "epochs", "cut_key", "cut_id", "cut_text", "cut_words"))


def with_cut(rows: DataFrame, cut_rows: DataFrame, n_sources: int) -> DataFrame:
    """``rows`` (with ``doc_id, source, mix_key, text_key``) and what the mix takes of each:

    ``epochs`` whole passes, then ``last``: all of the document, ``cut_words`` of it, or nothing.
    """
    c = F.broadcast(cut_rows) if n_sources <= BROADCAST_SOURCES else cut_rows
    c = c.withColumnRenamed("source", "_source")
    joined = rows.join(c, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    def at(k, i, t):
        # null ids sort first, as in the order of the prefix sums
        return F.struct(F.col(k), F.col(i).isNotNull(), F.coalesce(F.col(i), F.lit(0)), F.col(t))

    here, there = at("mix_key", "doc_id", "text_key"), at("cut_key", "cut_id", "cut_text")
    last = F.when(F.col("cut_key").isNull(), "none").when(here < there, "all").when(here == there, "cut").otherwise("none")
    return joined.withColumn("last", last)


def plan_mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: str = SEED, weights=default_weights):
    """``(sized rows, cut rows, number of sources)``; ``weights`` adds ``weight`` to ``(source, source_size)``."""
    rows = written(sized(docs, seed), "mix-sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    planned = written(targets(weights(sources), max_epochs), "mix-targets")
    cut_rows = written(cuts(rows, planned), "mix-cuts")
    return rows, cut_rows, planned.count()


def taken(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: str = SEED, weights=default_weights) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` of each row: the words that the mix takes of it."""
    rows, cut_rows, n = plan_mix(docs, max_epochs, seed, weights)
    got = with_cut(rows, cut_rows, n)
    last = F.when(F.col("last") == "all", F.col("size")).when(F.col("last") == "cut", F.col("cut_words")).otherwise(0)
    return got.select("doc_id", "source", "size", "source_size", "target",
                      (F.col("epochs") * F.col("size") + last).cast("bigint").alias("taken"))


@F.pandas_udf(T.StringType())
def _first_words(text: pd.Series, n: pd.Series) -> pd.Series:
    """Each text up to the end of its ``n``-th word; null stays null (every row but the few at a cut)."""
    def head(t, k):
        for i, m in enumerate(re.finditer(r"[^\x20\x09-\x0D]+", t), 1):
            if i >= k:
                return t[: m.end()]
        return t
    return pd.Series([None if t is None else head(t, k) for t, k in zip(text, n, strict=True)], dtype=object)


def mixed(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: str = SEED, weights=default_weights) -> DataFrame:
    """The mix itself: rows of ``docs`` (all columns), repeated by epoch; a document at a cut ends after its last taken word.

    Documents of size 0 take no budget and stay once.  ``n_chars``, if there, follows a shortened text.
    """
    _, cut_rows, n = plan_mix(docs, max_epochs, seed, weights)
    cols = docs.columns
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_doc"), "doc_id", "source",
                       mix_key(seed).alias("mix_key"), text_key(F.col("text")).alias("text_key"))
    got = with_cut(base, cut_rows, n)
    text = F.coalesce(F.col("_doc.text"), F.lit(""))
    empty = ~text.rlike(r"[^\x20\x09-\x0D]")
    cut_here = (F.col("last") == "cut") & (F.col("cut_words") > 0)
    head = F.col("_head")
    got = got.withColumn("_head", _first_words(F.when(cut_here, F.col("_doc.text")), F.col("cut_words")))
    copies = F.when(empty, F.array(F.lit(0))).otherwise(F.concat(
        F.when(F.col("epochs") > 0, F.sequence(F.lit(1), F.col("epochs").cast("int"))).otherwise(F.array().cast("array<int>")),
        F.when(F.col("last") == "all", F.array(F.lit(0))).when(head.isNotNull(), F.array(F.lit(-1))).otherwise(F.array().cast("array<int>"))))
    got = got.withColumn("_copy", F.explode(copies))
    short = F.col("_copy") == -1
    out = []
    for c in cols:
        v = F.col(f"_doc.`{c}`")
        if c == "text":
            v = F.when(short, head).otherwise(v)
        elif c == "n_chars":
            v = F.when(short, F.length(head).cast(docs.schema[c].dataType)).otherwise(v)
        out.append(v.alias(c))
    return got.select(*out)

"""Ratcliff/Obershelp similarity ``ratio(a, b) = 2*M / (len a + len b)``.

Spark has no built-in for this measure (``levenshtein`` is a different one),
so the per-pair work is a small Arrow-batched helper around the standard
library's ``difflib``.  Callers keep the number of pairs down: they score
*distinct* pairs only and skip pairs whose length bound already rules out a
hit (``ratio_upper_bound``).
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _ratio(a, b):
    if a is None or b is None:
        return None
    return SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(T.DoubleType())
def similarity_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Case-sensitive, not symmetric; 1.0 for two empty strings."""
    return pd.Series([_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def label_sums(lists, vocab: list[str]) -> list[list[float] | None]:
    """Per token list the sum of ratio(label, token) over its tokens, in their order, for each
    label; None for None.  A token repeated in ``lists`` is scored once."""
    memo: dict = {}

    def scored(token: str) -> list[float]:
        if token not in memo:
            sm = SequenceMatcher(None, "", token)  # b = token is indexed once
            memo[token] = []
            for label in vocab:
                sm.set_seq1(label)
                memo[token].append(sm.ratio())
        return memo[token]

    def total(tokens) -> list[float]:
        out = [0.0] * len(vocab)
        for token in tokens:
            out = [x + y for x, y in zip(out, scored(token))]
        return out

    return [None if t is None else total(t) for t in lists]


def label_sums_udf(labels: list[str]):
    """Arrow UDF of ``label_sums``: token array -> one sum per label (memo per batch)."""
    vocab = list(labels)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def sums(lists: pd.Series) -> pd.Series:
        return pd.Series(label_sums(lists, vocab), dtype="object")

    # marked non-deterministic so Catalyst never runs the helper once per use of its result
    return sums.asNondeterministic()


def ratio_upper_bound(a: Column, b: Column) -> Column:
    """Cheap bound ``2*min(la,lb)/(la+lb)`` >= ratio(a, b), computed in the JVM."""
    la, lb = F.length(a), F.length(b)
    return F.when(la + lb == 0, F.lit(1.0)).otherwise(
        F.least(la, lb) * 2.0 / (la + lb))

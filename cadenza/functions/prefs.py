"""Preference labels -> numeric request values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadenza.fixed import NOT_CHOSEN, PREFERENCE_BUCKETS


# Optional corrected table (our own, not the original's): loudness labels run from
# quiet to loud, and "not chosen" is the scoring default for loudness.
CORRECTED_BUCKETS = dict(PREFERENCE_BUCKETS, loudness=[
    ("Soft", -20.0, -10.0), ("Average Loudness", -10.0, -5.0), ("Very Loud", -5.0, 0.0)])
CORRECTED_NOT_CHOSEN = {"loudness": -10.1}


def hash_draw(seed: int, *parts: Column) -> Column:
    """A number in [0, 1): the first 52 bits of the md5 of ``seed`` and ``parts``, so it is the same in any layout."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def label_value(dimension: str, label: Column, mode: str = "midpoint", seed: int = 0,
                buckets: dict = PREFERENCE_BUCKETS, not_chosen: float | dict = NOT_CHOSEN,
                key: Column | None = None) -> Column:
    """N15 + N14: label -> range -> value; '' -> ``not_chosen``; unknown label -> null.

    ``mode='uniform'`` draws ``lo + u * (hi - lo)`` with ``u`` from a hash of the seed, the
    dimension and ``key`` (the request's id); without a key ``u`` is ``rand(seed)``, which
    depends on the rows' layout.  ``mode='midpoint'`` is the deterministic centre of the range.
    """
    if isinstance(not_chosen, dict):
        not_chosen = not_chosen.get(dimension, NOT_CHOSEN)
    u = F.rand(seed) if key is None else hash_draw(seed, F.lit(dimension), key)
    out = F.when(label == "", F.lit(not_chosen))
    for name, lo, hi in buckets[dimension]:
        if mode == "uniform":
            v = F.lit(lo) + u * F.lit(hi - lo)
        else:
            v = F.lit((lo + hi) / 2.0)
        out = out.when(label == name, v)
    return out.otherwise(F.lit(None).cast("double"))


def request_values(labels: dict[str, Column], mode: str = "midpoint", seed: int = 0,
                   buckets: dict = PREFERENCE_BUCKETS,
                   not_chosen: float | dict = NOT_CHOSEN, key: Column | None = None) -> dict[str, Column]:
    """All five dimensions at once (one column per dimension); pass
    ``CORRECTED_BUCKETS`` / ``CORRECTED_NOT_CHOSEN`` for the corrected table."""
    return {d: label_value(d, c, mode, seed + i, buckets, not_chosen, key)
            for i, (d, c) in enumerate(labels.items())}

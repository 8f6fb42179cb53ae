"""HTML unescape, media-link predicate, permalinks."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.fixed import LINK_TERMS


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: html.unescape(x) if x is not None else None)


def html_unescape(c: Column) -> Column:
    """Full HTML5 entity unescape (the standard library's table).

    Arrow-batched; ``html.unescape`` returns at once for text without '&', so
    rows without entities cost only the Arrow transfer.  Marked non-deterministic, so a
    filter on the result is not pushed below it with a second call.
    """
    return _unescape.asNondeterministic()(c)


def is_media_link(url: Column, terms: list[str] = LINK_TERMS) -> Column:
    """the url contains any of the terms (case-sensitive substring); null url is false."""
    cond = F.lit(False)
    for t in terms:
        cond = cond | F.coalesce(url.contains(t), F.lit(False))
    return cond


def matched_term(url: Column, terms: list[str] = LINK_TERMS) -> Column:
    """The first term found in the url (null when none)."""
    out = F.lit(None).cast("string")
    for t in reversed(terms):
        out = F.when(url.contains(t), F.lit(t)).otherwise(out)
    return out


def permalink(prefix: Column, post_id: Column) -> Column:
    """Feed permalink = feed prefix + post id."""
    return F.concat(prefix, post_id)

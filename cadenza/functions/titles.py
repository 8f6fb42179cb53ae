"""Post-title cleaning as Catalyst expressions (no UDF)."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadenza.fixed import TITLE_SEPARATOR

# Every code point Python's str.strip() removes (str.isspace()), built from the rule.
WHITESPACE = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())
_WS_CLASS = "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE)


def has_separator(title: Column, sep: str = TITLE_SEPARATOR) -> Column:
    """the title names artist and song ('A - B')."""
    return title.contains(sep)


def remove_tags(title: Column, tags: Column | list[str]) -> Column:
    """Remove literal tags, in the given order (an array column or a list)."""
    if isinstance(tags, list):
        for t in tags:
            title = F.replace(title, F.lit(t), F.lit(""))
        return title
    return F.aggregate(F.coalesce(tags, F.array().cast("array<string>")), title,
                       lambda acc, t: F.replace(acc, t, F.lit("")))


def truncate_title(title: Column, sep: str = TITLE_SEPARATOR) -> Column:
    """Cut at the first '(' and/or first '[' when it lies after the separator.

    Only the *first* '(' and the first '[' are looked at; the cut is at the
    earlier of those that come after the start of the separator.
    """
    s = F.locate(sep, title)
    p1 = F.locate("(", title)
    p2 = F.locate("[", title)
    cut = F.least(F.when(p1 > s, p1), F.when(p2 > s, p2))
    return F.when(cut.isNull(), title).otherwise(F.substring(title, F.lit(1), cut - 1))


def py_strip(c: Column) -> Column:
    """Python ``str.strip()``: remove every Unicode whitespace code point at both ends."""
    return F.regexp_replace(c, f"^[{_WS_CLASS}]+|[{_WS_CLASS}]+$", "")


def title_parts(truncated: Column, sep: str = TITLE_SEPARATOR) -> tuple[Column, Column]:
    """Split on the separator, keep parts 0 and 1, strip each."""
    parts = F.split(truncated, _regex_literal(sep), -1)
    return py_strip(F.element_at(parts, 1)), py_strip(F.try_element_at(parts, F.lit(2)))


def search_text(truncated: Column) -> Column:
    """Each run of non-letter/non-digit characters (``_`` included) becomes one space."""
    return F.regexp_replace(truncated, r"[^\p{L}\p{N}]+", " ")


def _regex_literal(s: str) -> str:
    return "".join("\\" + c if c in r".^$*+?()[]{}|\/" else c for c in s)


def clean_titles(df, title: str = "title", tags: Column | list[str] | None = None,
                 sep: str = TITLE_SEPARATOR):
    """Keep titles with the separator and add truncated, part0, part1, search_text."""
    t = F.col(title)
    base = remove_tags(t, tags) if tags is not None else t
    out = (df.where(has_separator(t, sep))
           .withColumn("truncated", truncate_title(base, sep)))
    p0, p1 = title_parts(F.col("truncated"), sep)
    return out.withColumns({"part0": p0, "part1": p1,
                            "search_text": search_text(F.col("truncated"))})

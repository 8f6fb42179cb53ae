"""Language identification with bit-sliced Bloom filters over letter trigrams.

One filter holds all languages: each of its slots is a bitmask with a bit per
language, so the AND of an n-gram's slots gives every language that has it.  A text
is decided by popcount: per language, the n-gram occurrences whose mask has its bit,
less the share that the language's own fill explains as false positives.

Training counts trigrams per language over all training rows.  A trigram belongs to
a language where it makes up at least ``min_rate`` of the language's trigrams and at
least ``share`` of the rate it has in the language that uses it most; rates, unlike
mere presence, do not fill up as the corpus grows, and they bound the filter's
entries to ``1 / min_rate`` per language.

Texts are lower-cased; a word's trigrams include its two ends.  A text that is null
or has no letter is ``und`` with score 0.  With no training rows every text is
``und``.  A text of which no trigram is known gets the most common language, score 0.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm import words as W
from cadenza.llm.shared import giving_back

UND = "und"
MIN_RATE = 1e-5
SHARE = 0.25
SLOT_BITS = 20
PROBES = 3
#: Entries that a task gathers before it hands them on.
_HELD = 1 << 20


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Lower-case code point of every letter, 0 for every other code point."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def trigrams(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes (three code points of 21 bits, exact) of a block of texts, and each row's bounds in them."""
    n = len(off) - 1
    joined = np.insert(buf, off[1:], 10)  # a line end after each row, so no trigram spans two
    points = np.frombuffer(joined.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    # rows' ends in code points: bytes that begin a code point
    begins = np.concatenate([[0], np.cumsum((joined & 0xC0) != 0x80)])
    ends = begins[off[1:] + np.arange(1, n + 1)]
    if begins[-1] != len(points):  # bytes that are no UTF-8: row by row
        texts = [buf[off[i]:off[i + 1]].tobytes().decode("utf-8", "replace") + "\n" for i in range(n)]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(t) for t in texts])
    s = np.concatenate([[np.uint32(0)], letters()[points]])  # index 0 stands before the first row
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    at = np.cumsum(keep)
    ends = at[ends] - 1          # each row's closing 0, or the 0 before it if the row has no letter
    s = s[keep].astype(np.uint64)
    if len(s) < 3:
        return np.empty(0, np.uint64), np.zeros(n + 1, np.int64)
    code = (s[:-2] << np.uint64(42)) | (s[1:-1] << np.uint64(21)) | s[2:]
    inside = s[1:-1] != 0
    upto = np.concatenate([[0], np.cumsum(inside)])
    bounds = np.concatenate([[0], upto[np.clip(ends - 1, 0, len(inside))]])
    return code[inside], np.maximum.accumulate(bounds)


def _slots(codes: np.ndarray, probes: int, bits: int) -> list[np.ndarray]:
    h = W.mix(codes * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    step = (h >> np.uint64(32)) | np.uint64(1)
    m = np.uint64((1 << bits) - 1)
    return [((h + np.uint64(j) * step) & m).astype(np.int64) for j in range(probes)]


class Model(NamedTuple):
    languages: list[str]   # most training text first; bit i of a mask is language i
    slots: np.ndarray      # uint64, (words of a mask, slots)
    false_rate: np.ndarray
    probes: int
    bits: int
    own: np.ndarray        # share of each language's own training trigrams that its filter holds

    def masks(self, codes: np.ndarray) -> np.ndarray:
        at = _slots(codes, self.probes, self.bits)
        out = self.slots[:, at[0]]
        for a in at[1:]:
            out &= self.slots[:, a]
        return out

    def scores(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Per row and language: the corrected share of the row's trigrams that the language has."""
        n = np.diff(bounds)
        hits = np.zeros((len(n), len(self.languages)))
        some = np.flatnonzero(n)
        if len(codes) and len(some):
            masks = self.masks(codes)
            for i in range(len(self.languages)):
                bit = ((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).astype(np.int64)
                hits[some, i] = np.add.reduceat(bit, bounds[some])
        n = np.maximum(n, 1)[:, None]
        return np.clip((hits - n * self.false_rate) / (1 - self.false_rate) / n, 0, 1)


def count_trigrams(rows: DataFrame) -> DataFrame:
    """``lang, code, n`` over all rows (``lang``, ``text``); null languages are left out."""
    def count(batches):
        held: dict[str, list] = {}
        size = 0

        def merged(parts):
            code, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
            return code, np.bincount(at, weights=np.concatenate([k for _, k in parts])).astype(np.int64)

        def out():
            for lang, parts in held.items():
                code, k = merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code.view(np.int64)), pa.array(k)],
                                                 names=["lang", "code", "n"])

        for b in batches:
            langs = b.column("lang").to_pylist()
            for at, to, buf, off in W.text_blocks(b.column("text")):
                codes, bounds = trigrams(buf, off)
                owner = np.repeat(np.arange(to - at), np.diff(bounds))
                names = np.array(langs[at:to], dtype=object)
                for lang in set(langs[at:to]):
                    mine = codes[(names == lang)[owner]]
                    code, k = np.unique(mine, return_counts=True)
                    held.setdefault(lang, []).append((code, k))
                    size += len(code)
            if size > _HELD:
                held = {lang: [merged(parts)] for lang, parts in held.items()}
                size = sum(len(p[0][0]) for p in held.values())
                if size > _HELD:
                    yield from out()
                    held, size = {}, 0
        yield from out()

    rows = rows.filter("lang is not null and text is not null").select("lang", "text")
    return rows.mapInArrow(giving_back(count), "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def fit(rows: DataFrame, min_rate: float = MIN_RATE, share: float = SHARE, bits: int = SLOT_BITS, probes: int = PROBES) -> Model:
    """The filter of the languages in ``rows`` (``lang``, ``text``)."""
    from cadenza.llm.shared import cut

    counts = cut(count_trigrams(rows))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    langs = sorted(((r["lang"], r["total"]) for r in totals.collect()), key=lambda x: (-x[1], x[0]))
    rated = counts.join(totals, "lang").withColumn("rate", F.col("n") / F.col("total"))
    top = rated.groupBy("code").agg(F.max("rate").alias("top"))
    # at most 1 / min_rate rows per language come to the driver
    chosen = (rated.filter(F.col("rate") >= min_rate).join(top, "code").filter(F.col("rate") >= F.col("top") * share)
              .select("lang", "code", "rate").toPandas())
    names = [x for x, _ in langs]
    slots = np.zeros((max(1, -(-len(names) // 64)), 1 << bits), np.uint64)
    false, own = np.zeros(len(names)), np.zeros(len(names))
    for i, name in enumerate(names):
        mine = chosen[chosen["lang"] == name]
        own[i] = mine["rate"].sum()
        codes = mine["code"].to_numpy(np.int64).view(np.uint64)
        for at in _slots(codes, probes, bits):
            slots[i // 64, at] |= np.uint64(1) << np.uint64(i % 64)
        fill = ((slots[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()
        false[i] = min(fill ** probes, 0.5)
    return Model(names, slots, false, probes, bits, own)


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every row with ``lang_pred`` and ``score``; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    text = "text" if "text" in keep else "_text"

    def run(batches):
        m = Model(*shared.value)
        for b in batches:
            lang, score = [], []
            for at, to, buf, off in W.text_blocks(b.column(text)):
                codes, bounds = trigrams(buf, off)
                if not m.languages:
                    lang += [UND] * (to - at)
                    score += [0.0] * (to - at)
                    continue
                s = m.scores(codes, bounds)
                best = s.argmax(axis=1)
                none = np.diff(bounds) == 0
                lang += [UND if z else m.languages[i] for i, z in zip(best.tolist(), none.tolist(), strict=True)]
                score += np.where(none, 0.0, s[np.arange(to - at), best]).tolist()
            yield pa.RecordBatch.from_arrays([*b.select(keep).columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=[*keep, "lang_pred", "score"])

    base = docs.select(*[F.col(f"`{c}`") for c in keep], *([] if text in keep else [F.col("text").alias(text)]))
    return base.mapInArrow(giving_back(run), T.StructType([*base.schema.fields[:len(keep)], T.StructField("lang_pred", T.StringType()),
                                              T.StructField("score", T.DoubleType())]))


def held_out() -> Column:
    """The fold that is never trained on: crc32 of doc_id as text, mod 4, is 2 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2

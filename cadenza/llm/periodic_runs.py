"""Periodic runs of words: every maximal stretch that repeats itself, at every period, in texts of any length.

A run is a stretch of words with smallest period q (words q apart are equal), of at least
``max(MIN_LENGTH, 2 q)`` words, that no neighbouring word extends.  Periods are dealt out by
octaves [2^k, 2^(k+1)) (the first takes 1 to 7).  In an octave every run crosses one of the
boundaries 2^k apart with a whole period to its right, so each boundary is solved by itself:
a Z-function of the words from it on, and one of the words before it read backwards, tell for every
period of the octave how far the words agree with themselves q places on.  A document becomes
overlapping tiles of ``TILE`` boundaries per octave; tiles are spread over all tasks, solved
independently, and their fragments (cut at a tile's edges) meet by document and period and are
stitched: fragments of one period that overlap by a period or more belong to one run.

Only tiles with words of a repeated 6-gram are sent out: a run of period q has six or more
consecutive words that are equal q places on.  A fragment whose period is a multiple of a
smaller one is recognised in its own tile, from the same Z-functions.

Texts are read once; those without a repeated 6-gram have no run and are finished there and then.
The rest (``words``) are written to the shared folder, and only they are shuffled.

Defined cases: null and empty texts have no words and no run; a text shorter than ``MIN_LENGTH``
has none; repeated rows, equal and null ids are told apart by a row number; an empty table gives an
empty result; other columns are not read.  Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm import words as W
from cadenza.llm.shared import written

MIN_LENGTH = 12
#: A run has this many consecutive words, at least, that are equal a period on: max(12 - q, q) >= 6.
GRAM = 6
#: Boundaries in a tile (8 at least, so that a window reaches into neighbouring tiles only).
TILE = 32
#: Periods of the first octave end here; its boundaries are 4 words apart.
FIRST_END = 8

RUN = "struct<start:bigint,length:bigint,period:bigint>"
#: For each word of a block, the word that takes its place: ``(doc ids, bounds) -> indices``.
Rewrite = Callable[[list, np.ndarray], np.ndarray]


# ---- one octave ------------------------------------------------------------------------

def octaves(n: int) -> Iterator[tuple[int, int, int, int]]:
    """``(stride, first period, end of periods, reach)`` of the octaves that a text of ``n`` words can fill."""
    stride, low = FIRST_END // 2, 1
    while 2 * low <= n:
        yield stride, low, 2 * stride, max(16, 2 * stride)
        stride, low = 2 * stride, 2 * stride


def z_function(s: list, need: int) -> list[int]:
    """For each of the first ``need`` places, how many elements from there on equal the beginning."""
    n = len(s)
    z, left, right = [0] * need, 0, 0
    for i in range(1, need):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _primes(q: int) -> list[int]:
    out, d = [], 2
    while d * d <= q:
        if q % d == 0:
            out.append(d)
            while q % d == 0:
                q //= d
        d += 1
    return out + [q] * (q > 1)


def solve(x: list, at: int, first: int, end: int, stride: int, low: int, high: int, reach: int) -> dict[int, list[list[int]]]:
    """Fragments ``period -> [[start, end], ...]`` around the boundaries of [first, end) that are multiples of ``stride``.

    ``x`` holds the words from place ``at`` on, ``reach`` before the first boundary and
    ``high + reach`` after the last (as far as the text has them).
    """
    found: dict[int, list[list[int]]] = {}
    for c in range(first, min(end, at + len(x)), stride):
        o = c - at
        top = min(high, len(x) - o + 1)  # periods below this fit
        if top <= low:
            continue
        ahead = z_function(x[o: o + top - 1 + reach], top)
        before = x[max(0, o - reach): o][::-1]
        # place top - 1 - q of the text read backwards from c + top - 2 is the last word before c + q
        text = x[max(0, o - reach): o + top - 1][::-1]
        back = z_function([*before, None, *text], len(before) + top)[len(before) + 1:]
        for q in range(low, top):
            right = min(ahead[q], reach) if q < len(ahead) else 0
            left = min(back[top - 1 - q], len(before)) if top - 1 - q < len(back) else 0
            if left + right < max(MIN_LENGTH - q, q):
                continue
            if any(ahead[r] >= q + right - r and back[top - 1 - r] >= left for r in (q // d for d in _primes(q))):
                continue  # a smaller period divides this one here, and so in the whole run
            spans = found.setdefault(q, [])
            if spans and c - left <= spans[-1][1] - q:
                spans[-1][1] = max(spans[-1][1], c + q + right)
                spans[-1][0] = min(spans[-1][0], c - left)
            else:
                spans.append([c - left, c + q + right])
    return found


def repeats(grams: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(place, distance)`` of each gram that occurs again in its row, and how far on it does so first."""
    key = W.mix(grams ^ W.mix(row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order][1:] == key[order][:-1])
    return order[same], order[same + 1] - order[same]


def tiles(ids: np.ndarray, place: np.ndarray, distance: np.ndarray) -> Iterator[tuple]:
    """Tiles of one text that may hold a run: ``(stride, low, high, reach, first, at, words)``."""
    n = len(ids)
    for stride, low, high, reach in octaves(n):
        size = TILE * stride
        here = place[distance < high]
        if not len(here):
            continue
        near = [np.clip((here + d) // size, 0, (n - 1) // size) for d in (-high - reach, 0, reach)]
        for t in np.unique(np.concatenate(near)).tolist():
            at = max(0, t * size - reach)
            part = ids[at: (t + 1) * size + high + reach]
            _, code = np.unique(part, return_inverse=True)
            yield stride, low, high, reach, t * size, at, code.astype(np.uint16 if len(part) < 1 << 16 else np.uint32)


# ---- the operator ----------------------------------------------------------------------

_WORDS = "row bigint, doc_id bigint, n_words bigint, collapsed string, collapsed_sha256 string, words string"
_TILES = "row bigint, stride bigint, low bigint, high bigint, reach bigint, first bigint, at bigint, n bigint, words binary"
#: Tiles a batch holds before it is handed on, by bytes.
_HELD = 4 << 20


def _batch(schema: str, columns: list[list]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names, strict=True)], names=[n for n, _ in names])


def _split(rewrite: Rewrite | None, with_text: bool):
    """Texts without a repeated gram, finished; of the others, their words."""

    def run(batches):
        for b in batches:
            ids, rows = b.column("doc_id").to_pylist(), b.column("row").to_pylist()
            for at, to, buf, off in W.text_blocks(b.column("text")):
                w = W.words(buf, off, W.NOT_SPACE, lower=False)
                src = np.arange(len(w.start)) if rewrite is None else rewrite(ids[at:to], w.bounds)
                grams = W.ngrams(w.hash[src], GRAM)[W.inside_rows(w.bounds, GRAM)]
                row = np.repeat(np.arange(to - at), np.maximum(np.diff(w.bounds) - GRAM + 1, 0))
                place, _ = repeats(grams, row)
                some = np.zeros(to - at, bool)
                some[row[place]] = True
                data = w.buf.tobytes()
                start, end = w.start.tolist(), w.end.tolist()
                out: list[list] = [[] for _ in range(6)]
                for i in range(to - at):
                    lo, hi = int(w.bounds[i]), int(w.bounds[i + 1])
                    text = b" ".join([data[start[j]: end[j]] for j in src[lo:hi].tolist()])
                    whole = text.decode()
                    for c, v in zip(out, (rows[at + i], ids[at + i], hi - lo, whole if with_text and not some[i] else None,
                                          None if some[i] else sha256(text).hexdigest(), whole if some[i] else None), strict=True):
                        c.append(v)
                yield _batch(_WORDS, out)

    return run


def _tiled(batches):
    out, held = [[] for _ in range(9)], 0
    for b in batches:
        rows = b.column("row").to_pylist()
        for at, to, buf, off in W.text_blocks(b.column("words")):
            w = W.words(buf, off, W.NOT_SPACE, lower=False)
            for i in range(to - at):
                ids = w.hash[int(w.bounds[i]): int(w.bounds[i + 1])]
                place, distance = repeats(W.ngrams(ids, GRAM), np.zeros(max(0, len(ids) - GRAM + 1), np.int64))
                for stride, low, high, reach, first, begin, code in tiles(ids, place, distance):
                    data = code.tobytes()
                    for c, v in zip(out, (rows[at + i], stride, low, high, reach, first, begin, len(code), data), strict=True):
                        c.append(v)
                    held += len(data)
                    if held > _HELD:
                        yield _batch(_TILES, out)
                        out, held = [[] for _ in range(9)], 0
    if out[0]:
        yield _batch(_TILES, out)


def _solved(batches):
    for b in batches:
        out: list[list] = [[] for _ in range(4)]
        for r in b.to_pylist():
            x = np.frombuffer(r["words"], np.uint16 if len(r["words"]) == 2 * r["n"] else np.uint32).tolist()
            found = solve(x, r["at"], r["first"], r["first"] + TILE * r["stride"], r["stride"], r["low"], r["high"], r["reach"])
            for q, spans in found.items():
                for s, e in spans:
                    for c, v in zip(out, (r["row"], q, s, e), strict=True):
                        c.append(v)
        yield _batch("row bigint, period bigint, start bigint, end bigint", out)


def stitched(fragments: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``row, runs`` (by start, then period): fragments of one period that overlap by a period make one run."""
    order = Window.partitionBy("row", "period").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col("start") > before - F.col("period")), 1).otherwise(0)
    joined = (fragments.withColumn("new", new).withColumn("run", F.sum("new").over(order))
              .groupBy("row", "period", "run").agg(F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length")))
    runs = joined.filter(F.col("length") >= F.greatest(F.lit(min_length), 2 * F.col("period")))
    runs = runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("r"))
    return runs.select("row", F.transform("r", lambda r: F.struct(r["start"], r["length"], r["period"])).cast(f"array<{RUN}>").alias("runs"))


def _collapsed(batches):
    """Words in a run after its first period go."""
    for b in batches:
        texts, digests = [], []
        for text, runs in zip(b.column("words").to_pylist(), b.column("runs").to_pylist(), strict=True):
            words = text.split(" ")
            change = np.zeros(len(words) + 1, np.int64)
            for r in runs:
                change[r["start"] + r["period"]] += 1
                change[r["start"] + r["length"]] -= 1
            gone = np.cumsum(change[:-1]) > 0
            kept = " ".join([x for x, g in zip(words, gone.tolist(), strict=True) if not g])
            texts.append(kept)
            digests.append(sha256(kept.encode()).hexdigest())
        runs = pa.array([[(r["start"], r["length"], r["period"]) for r in v] for v in b.column("runs").to_pylist()],
                        pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_words"), runs, pa.array(texts, pa.string()),
                                          pa.array(digests, pa.string())], names=["doc_id", "n_words", "runs", "collapsed", "collapsed_sha256"])


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None, with_text: bool = True) -> DataFrame:
    """``doc_id, n_words, runs, collapsed, collapsed_sha256`` of each row of ``docs`` (``doc_id, text``).

    ``runs``: start, length and period of every run, by start, then period.  ``collapsed``: the words
    joined by one space, without those that repeat the first period of a run (``with_text=False``: null for texts
    without a repeated 6-gram, whose digest is there all the same).
    """
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    split = written(rows.mapInArrow(_split(rewrite, with_text), _WORDS), "periodic-words")
    open_ = split.filter("words is not null")
    sent = open_.select("row", "words").mapInArrow(_tiled, _TILES)
    # by a hash of the tile, so that a long text's tiles are spread
    sent = sent.repartition("row", "stride", "first")
    runs = stitched(sent.mapInArrow(_solved, "row bigint, period bigint, start bigint, end bigint"))
    none = F.array().cast(f"array<{RUN}>")
    told = open_.join(runs, "row", "left").select("doc_id", "n_words", "words", F.coalesce("runs", none).alias("runs"))
    told = told.mapInArrow(_collapsed, f"doc_id bigint, n_words bigint, runs array<{RUN}>, collapsed string, collapsed_sha256 string")
    done = split.filter("words is null").select("doc_id", "n_words", none.alias("runs"), "collapsed", "collapsed_sha256")
    return done.union(told)


# ---- the registered query ----------------------------------------------------------------

def planted(ids: list, bounds: np.ndarray) -> np.ndarray:
    """Each tenth document (by the CRC-32 of its decimal id) repeats itself from a place on; null ids do not."""
    src = np.arange(int(bounds[-1]))
    for i, doc_id in enumerate(ids):
        lo, n = int(bounds[i]), int(bounds[i + 1] - bounds[i])
        if doc_id is None or n == 0:
            continue
        h = zlib.crc32(str(doc_id).encode())
        if h % 10:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        src[lo + a: lo + n] = lo + a + np.arange(n - a) % p
    return src

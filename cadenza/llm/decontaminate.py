"""Benchmark decontamination by winnowing.

Of every run of ``window`` consecutive k-gram hashes the smallest are kept, on both
sides and by the same rule, so any shared span of ``k + window - 1`` words has a
kept k-gram in common.  Documents' kept k-grams are looked up among the test items'
and every match is extended word by word to both sides; a matched run of ``span``
words or more contains windows of the item, and its words are hit.  An item of
fewer than ``span`` words is one window of its own length; such items are looked up
by the hash of all their words.

The test items are the stated query set: they go to the tasks in blocks of checked
size, and every block is held against all documents.  A document is never shuffled.

Null texts and texts without words have no words and no hits.  Items without words
match nothing; equal items are all found.  Empty tables give no hits or no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm import words as W
from cadenza.llm.shared import giving_back

SPAN = 13
KGRAM = 6
#: Bytes of test items that a task holds at once; more items make more blocks.
BLOCK_BYTES = 16 << 20


def kept(grams: np.ndarray, whole: np.ndarray, window: int) -> np.ndarray:
    """Positions of the k-grams that are smallest in some run of ``window`` of them.

    ``whole``: for each run, whether it lies in one text.  Equal minima are all kept.
    """
    n = len(grams) - window + 1
    if n <= 0:
        return np.empty(0, np.int64)
    least = grams[:n].copy()
    for j in range(1, window):
        np.minimum(least, grams[j: j + n], out=least)
    whole = whole[:n]
    mark = np.zeros(len(grams), bool)
    for j in range(window):
        mark[j: j + n] |= whole & (grams[j: j + n] == least)
    return np.flatnonzero(mark)


class Items:
    """Test items as word hashes, with the look-up tables of their fingerprints."""

    def __init__(self, ids: list[str], texts: list[str | None], span: int, k: int):
        self.ids, self.span, self.k, self.window = ids, span, k, span - k + 1
        self.hash, self.first, self.short = np.empty(0, np.uint64), np.zeros(1, np.int64), {}
        parts, bounds = [np.empty(0, np.uint64)], [0]
        for _, _, buf, off in W.text_blocks(pa.array(texts, pa.large_string())):
            w = W.words(buf, off, W.ALNUM)
            parts.append(w.hash)
            bounds += (w.bounds[1:] + bounds[-1]).tolist()
        self.hash, self.first = np.concatenate(parts), np.array(bounds, np.int64)
        for i in range(len(ids)):
            own = self.words(i)
            if 0 < len(own) < span:
                self.short.setdefault(len(own), {}).setdefault(int(W.ngrams(own, len(own))[0]), []).append(i)
        grams = W.ngrams(self.hash, k)
        at = kept(grams, W.inside_rows(self.first, span), self.window)
        order = np.argsort(grams[at], kind="stable")
        self.prints, self.at = grams[at][order], at[order]

    def words(self, i: int) -> np.ndarray:
        return self.hash[self.first[i]: self.first[i + 1]]

    def extend(self, doc: np.ndarray, p: int, q: int) -> tuple[int, int, int, int]:
        """The item at word ``q`` of all items, and the run of equal words around (p, q): item, start, end, q - p."""
        i = int(np.searchsorted(self.first, q, side="right")) - 1
        lo, hi = int(self.first[i]), int(self.first[i + 1])
        back = min(p, q - lo)
        unlike = np.flatnonzero(doc[p - back: p][::-1] != self.hash[q - back: q][::-1])
        back = int(unlike[0]) if len(unlike) else back
        on = min(len(doc) - p, hi - q)
        unlike = np.flatnonzero(doc[p: p + on] != self.hash[q: q + on])
        on = int(unlike[0]) if len(unlike) else on
        return i, p - back, p + on, q - p


def find_hits(items: Items, w: W.Words) -> dict[int, tuple[list[tuple[int, int]], set[int]]]:
    """Per row of the block with hits: runs of hit words, and the indexes of the items found."""
    found: dict[int, tuple[list[tuple[int, int]], set[int]]] = {}
    if len(items.prints):
        grams = W.ngrams(w.hash, items.k)
        at = kept(grams, W.inside_rows(w.bounds, items.span), items.window)
        h = grams[at]
        lo = np.searchsorted(items.prints, h, side="left")
        some = lo < len(items.prints)
        some[some] = items.prints[lo[some]] == h[some]
        at, lo = at[some], lo[some]
        hi = np.searchsorted(items.prints, grams[at], side="right")
        row = np.searchsorted(w.bounds, at, side="right") - 1
        open_until: dict[tuple[int, int], int] = {}  # of the row at hand: (item, shift) -> end of the last run
        last = -1
        for p, r, x, y in zip(at.tolist(), row.tolist(), lo.tolist(), hi.tolist(), strict=True):
            base = int(w.bounds[r])
            if r != last:
                open_until, last = {}, r
                doc = w.hash[base: w.bounds[r + 1]]
            for q in items.at[x:y].tolist():
                i = int(np.searchsorted(items.first, q, side="right")) - 1
                shift = q - (p - base)
                if open_until.get((i, shift), -1) > p - base:
                    continue
                i, a, b, shift = items.extend(doc, p - base, q)
                open_until[i, shift] = b
                if b - a >= items.span:
                    runs, which = found.setdefault(r, ([], set()))
                    runs.append((a, b))
                    which.add(i)
    for n, known in items.short.items():
        grams = W.ngrams(w.hash, n)
        keys = np.array(sorted(known), np.uint64)
        lo = np.searchsorted(keys, grams)
        lo[lo == len(keys)] = 0
        at = np.flatnonzero((keys[lo] == grams) & W.inside_rows(w.bounds, n))
        row = np.searchsorted(w.bounds, at, side="right") - 1
        for p, r in zip(at.tolist(), row.tolist(), strict=True):
            runs, which = found.setdefault(r, ([], set()))
            a = p - int(w.bounds[r])
            runs.append((a, a + n))
            which.update(known[int(grams[p])])
    return found


def merged_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_blocks(items: DataFrame, block_bytes: int) -> list[list[tuple[str, str | None]]]:
    """Test items (id as string, text) in blocks of at most about ``block_bytes``, dealt by hash."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // block_bytes) + 1
    if n == 1:
        return [[tuple(r) for r in rows.collect()]]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return ([tuple(r) for r in rows.filter(part == i).collect()] for i in range(n))


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = KGRAM,
                  block_bytes: int = BLOCK_BYTES, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default ``doc_id``) of every row of ``docs`` and what was found in its text:

    ``n_words``, ``runs`` (sorted, disjoint word runs ``[from, to)`` that are hit) and
    ``items`` (sorted ids of the items found, as strings; null ids are left out).
    """
    spark = docs.sparkSession
    keep = keep or ["doc_id"]
    found = T.StructType.fromDDL("n_words bigint, runs array<struct<from:int,to:int>>, items array<string>").fields
    kept_fields = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.fields
    # the text column goes to Python once, under its own name if it is kept
    text = "text" if "text" in keep else "_text"
    base = docs.select(*[F.col(f"`{c}`") for c in keep], *([] if text in keep else [F.col("text").alias(text)]))

    run_type = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))

    def scan(pairs):
        ids, texts = [i for i, _ in pairs], [t for _, t in pairs]
        shared = spark.sparkContext.broadcast((ids, texts))

        def run(batches):
            items = Items(*shared.value, span, k)
            for b in batches:
                n, runs, which = [], [], []
                for _, _, buf, off in W.text_blocks(b.column(text)):
                    w = W.words(buf, off, W.ALNUM)
                    n += np.diff(w.bounds).tolist()
                    hits = find_hits(items, w)
                    for r in range(len(off) - 1):
                        rr, ii = hits.get(r, ((), ()))
                        runs.append([{"from": a, "to": z} for a, z in merged_runs(list(rr))])
                        which.append(sorted({items.ids[i] for i in ii if items.ids[i] is not None}))
                yield pa.RecordBatch.from_arrays(
                    [*b.select(keep).columns, pa.array(n, pa.int64()), pa.array(runs, run_type), pa.array(which, pa.list_(pa.string()))],
                    names=[*keep, "n_words", "runs", "items"])
        return giving_back(run)

    blocks = item_blocks(benchmark, block_bytes)
    if isinstance(blocks, list):
        return base.mapInArrow(scan(blocks[0]), T.StructType([*kept_fields, *found]))
    # several blocks: each is held against all documents, what they found is put together by row
    from cadenza.llm.shared import written

    rows = written(base.withColumn("_row", F.monotonically_increasing_id()), "decontaminate-rows")
    base, keep = rows, [*keep, "_row"]
    schema = T.StructType([*kept_fields, T.StructField("_row", T.LongType()), *found])
    parts = [written(base.mapInArrow(scan(pairs), schema), "decontaminate-block") for pairs in blocks]
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    # runs of one row, found by several blocks, that touch or overlap become one
    spans = every.select("_row", F.explode("runs").alias("r")).select("_row", F.col("r.from").alias("from"), F.col("r.to").alias("to"))
    order = Window.partitionBy("_row").orderBy("from", "to")
    before = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.when(before.isNull() | (F.col("from") > before), 1).otherwise(0))
    spans = (spans.withColumn("run", F.sum("new").over(order)).groupBy("_row", "run").agg(F.min("from").alias("from"), F.max("to").alias("to"))
             .groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("runs")))
    grouped = every.groupBy("_row").agg(
        *[F.first(c).alias(c) for c in keep if c != "_row"], F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    none = F.array().cast("array<struct<from:int,to:int>>")
    return (grouped.join(spans, "_row", "left").withColumn("runs", F.coalesce("runs", none))
            .select(*[c for c in keep if c != "_row"], "n_words", "runs", "items"))


def hit_words():
    return F.aggregate("runs", F.lit(0).cast("bigint"), lambda s, r: s + (r["to"] - r["from"]))


def contaminated():
    """The rule of the contract: any hit, and a twentieth of the words or more."""
    return (F.col("n_hit") > 0) & (F.lit(20) * F.col("n_hit") >= F.col("n_words"))


def digest_items(ids: list[str]) -> str:
    return hashlib.sha256(",".join(ids).encode()).hexdigest()

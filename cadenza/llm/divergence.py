"""Term divergence between sources and their language, over terms found by iceberg prefix refinement.

Terms are runs of letters and non-ASCII characters, A-Z lower-cased.  A language keeps the
terms that at least ``MIN_DOCS`` of its documents hold.  They are found without counting every
term of the corpus: a term can only be kept if each of its byte prefixes is held by that many
documents.  So prefixes are extended level by level (``LEVELS`` bytes); at each level tasks count
distinct documents per (language, prefix) among terms whose shorter prefix survived, Spark adds
the counts, and prefixes below the threshold are discarded.  The survivors travel to the next level
as a bitmap of fixed size, which may let a rare prefix through but never discards a frequent
one; complete terms are counted by their own text at the end, so the result is exact.

Occurrences of kept terms per (language, source) come from the same last pass.  With ``N`` the
occurrences of kept terms, ``V`` kept terms and ``c`` a term's count, its probability is
``1 + floor(10^9 (c + 5) / (N + 5 V))`` in exact integers, for each source and the language.

Defined cases: null text, lang and source are empty strings; a source without terms, and a
language without kept terms, still has its pairs (0 where nothing is kept); a repeated row is one
more document; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm import words as W
from cadenza.llm.shared import cut, shuffle_width, signed

MIN_DOCS = 30
TOP_TERMS = 50
#: Prefix lengths in bytes, one pass over the documents each; complete terms follow.
LEVELS = (4, 9)
#: Added to every count; scale of the probabilities.
PSEUDO, SCALE = 5, 1_000_000_000
#: Bits of the survivors' bitmap (16 MB, on the driver and in each worker).
MAP_BITS = 27
_CHUNK = 1 << 16
#: Sources and terms of a tile of the pair sums (a matrix of 8 bytes each in one task).
TILE = (256, 256)
#: Entries that a task gathers before it hands its counts on.
_HELD = 1 << 20

#: Words ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` of text whose A-Z are lower-cased.
LETTERS = np.array([b >= 0x80 or 0x61 <= b <= 0x7A for b in range(256)], dtype=bool)


def _salt(names: Iterable[str]) -> np.ndarray:
    """A 64-bit number per language."""
    return np.array([int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "little") for x in names], np.uint64)


def _prefix_keys(w: W.Words, lang: np.ndarray, length: int | None) -> np.ndarray:
    """64-bit key of each word's language and first ``length`` bytes (None: of the complete word)."""
    end = w.end if length is None else np.minimum(w.end, w.start + length)
    return W.mix(W._hash_spans(w.buf, w.start, end) ^ lang)


def _passes(bitmap: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
    if bitmap is None:
        return np.ones(len(keys), bool)
    at = keys >> np.uint64(64 - MAP_BITS)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _codes(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    column = pc.fill_null(column.cast(pa.string()), "")
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def _in_blocks(batch: pa.RecordBatch, length: int | None, bitmap: np.ndarray | None):
    """Per block of a batch of (lang, text, ...): rows from, words that pass, each word's row, lang salts."""
    codes, names = _codes(batch.column("lang"))
    salts = _salt(names)
    for at, to, buf, off in W.text_blocks(batch.column("text")):
        w = W.words(buf, off, LETTERS, hashes=False)
        if not len(w.start):
            continue
        row = np.repeat(np.arange(at, to), np.diff(w.bounds))
        salt = salts[codes[row]]
        if bitmap is not None:
            keep = _passes(bitmap, _prefix_keys(w, salt, length))
            w = W.Words(w.hash, w.start[keep], w.end[keep], w.bounds, w.buf)
            row, salt = row[keep], salt[keep]
        yield w, row, salt


def prefix_documents(docs: DataFrame, length: int, shorter: int | None, bitmap) -> DataFrame:
    """``key, docs``: distinct documents per (language, prefix of ``length`` bytes), for prefixes whose
    first ``shorter`` bytes survived (the broadcast ``bitmap``)."""

    def count(batches):
        held = (np.empty(0, np.uint64), np.empty(0, np.int64))
        for b in batches:
            for w, row, salt in _in_blocks(b, shorter, None if bitmap is None else bitmap.value):
                keys = _prefix_keys(w, salt, length)
                order = np.lexsort((keys, row))  # each document's prefixes once
                keys, row = keys[order], row[order]
                first = np.ones(len(keys), bool)
                first[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
                held = _added(held, np.unique(keys[first], return_counts=True))
                if len(held[0]) > _HELD:
                    yield _counted(held)
                    held = (held[0][:0], held[1][:0])
        if len(held[0]):
            yield _counted(held)

    return docs.select("lang", "text").mapInArrow(count, "key bigint, docs bigint").groupBy("key").agg(F.sum("docs").alias("docs"))


def _added(a, b):
    keys, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, at, np.concatenate([a[1], b[1]]))
    return keys, counts


def _counted(held) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(signed(held[0])), pa.array(held[1])], names=["key", "docs"])


def survivors(counts: DataFrame, min_docs: int = MIN_DOCS) -> np.ndarray:
    """Bitmap of the keys that at least ``min_docs`` documents hold; its size does not depend on the data."""

    def mark(batches):
        parts: dict[int, np.ndarray] = {}
        for b in batches:
            at = b.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - MAP_BITS)
            byte, bit = (at >> np.uint64(3)).astype(np.int64), np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8))
            for c in np.unique(byte // _CHUNK).tolist():
                here = byte // _CHUNK == c
                np.bitwise_or.at(parts.setdefault(c, np.zeros(_CHUNK, np.uint8)), byte[here] % _CHUNK, bit[here])
        for c, v in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([v.tobytes()], pa.binary())], names=["chunk", "bits"])

    def merge(batches):
        parts: dict[int, np.ndarray] = {}
        for b in batches:
            for c, v in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                v = np.frombuffer(v.as_buffer(), np.uint8)
                parts[c] = parts[c] | v if c in parts else v.copy()
        for c, v in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([v.tobytes()], pa.binary())], names=["chunk", "bits"])

    chunks = (1 << MAP_BITS) // 8 // _CHUNK
    marked = counts.filter(F.col("docs") >= min_docs).select("key").mapInArrow(mark, "chunk int, bits binary")
    merged = marked.repartition(min(shuffle_width(counts.sparkSession), chunks), "chunk").mapInArrow(merge, "chunk int, bits binary")
    out = np.zeros(chunks * _CHUNK, np.uint8)
    for c, v in merged.collect():  # one row per chunk: 256 rows of 64 KB at most
        out[c * _CHUNK: (c + 1) * _CHUNK] = np.frombuffer(bytes(v), np.uint8)
    return out


def term_counts(docs: DataFrame, length: int | None, bitmap) -> DataFrame:
    """``lang, source, term, n`` (occurrences) and ``docs`` (documents) of terms whose prefix survived."""

    def count(batches):
        for b in batches:
            lang, langs = _codes(b.column("lang"))
            source, sources = _codes(b.column("source"))
            group = lang.astype(np.int64) * len(sources) + source
            for w, row, salt in _in_blocks(b, length, None if bitmap is None else bitmap.value):
                if not len(row):
                    continue
                keys = _prefix_keys(w, salt, None)
                order = np.lexsort((row, keys, group[row]))
                g, k, r = group[row][order], keys[order], row[order]
                new = np.ones(len(k), bool)
                new[1:] = (k[1:] != k[:-1]) | (g[1:] != g[:-1])
                starts = np.flatnonzero(new)
                n = np.diff(np.append(starts, len(k)))
                other = new.copy()
                other[1:] |= r[1:] != r[:-1]
                held = np.add.reduceat(other.astype(np.int64), starts)
                one = order[starts]  # a word stands for its equals
                yield pa.RecordBatch.from_arrays([
                    pa.array(langs).take(pa.array(g[starts] // len(sources))), pa.array(sources).take(pa.array(g[starts] % len(sources))),
                    _spans(w.buf, w.start[one], w.end[one]), pa.array(n), pa.array(held)], names=["lang", "source", "term", "n", "docs"])

    rows = docs.select("lang", "source", "text").mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The strings ``buf[start:end]`` as one Arrow array."""
    n = end - start
    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    data = buf[np.repeat(start - offsets[:-1], n) + np.arange(int(offsets[-1]))]
    return pa.StringArray.from_buffers(len(n), pa.py_buffer(offsets), pa.py_buffer(data.tobytes()))


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS, levels: tuple[int, ...] = LEVELS) -> tuple[DataFrame, DataFrame]:
    """``lang, term, n_term`` of each language's kept terms, and ``lang, source, term, n, n_term`` per source
    that holds them.  ``docs`` has ``lang, source, text``."""
    spark = docs.sparkSession
    bitmap, shorter = None, None
    for length in levels:
        counts = prefix_documents(docs, length, shorter, bitmap)
        told = survivors(counts, min_docs)
        if bitmap is not None:
            bitmap.unpersist()
        bitmap, shorter = spark.sparkContext.broadcast(told), length
    # complete terms; their documents over all sources of the language decide
    terms = cut(term_counts(docs, shorter, bitmap))
    kept = cut(terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_term"))
               .filter(F.col("docs") >= min_docs).select("lang", "term", "n_term"))
    return kept, cut(terms.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "n_term"))


def _share(count: str, total: str, kept: str):
    """``1 + floor(SCALE (count + PSEUDO) / (total + PSEUDO kept))`` in exact integers."""
    return F.expr(f"1 + (cast({count} + {PSEUDO} as decimal(20,0)) * cast({SCALE} as decimal(10,0))) "
                  f"div (cast({total} as decimal(20,0)) + {PSEUDO} * cast({kept} as decimal(15,0)))")


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, levels: tuple[int, ...] = LEVELS,
               tile: tuple[int, int] = TILE) -> DataFrame:
    """``lang, source, part, item, value, rank`` per (language, source) of ``docs`` (``text, lang, source``).

    Part ``pair``: each other source of the language, by the summed distance of the kept terms'
    probabilities.  Part ``term``: the ``top`` kept terms that the source has above its language.
    """
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept, terms = kept_terms(docs, min_docs, levels)
    per_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n_term").alias("n_lang"))
    per_source = terms.groupBy("lang", "source").agg(F.sum("n").alias("n_source"))
    every = docs.select("lang", "source").distinct()
    # one row per (language, source): the windows run over a language's list of sources
    own = Window.partitionBy("lang")
    groups = (every.join(per_lang, "lang", "left").join(per_source, ["lang", "source"], "left")
              .select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("v", "n_lang", "n_source")])
              .withColumns({"no": F.row_number().over(own.orderBy("source")) - 1, "sources": F.count(F.lit(1)).over(own)})
              .withColumns({"p0": F.when(F.col("v") > 0, _share("0", "n_source", "v")),
                            "block": F.floor(F.col("no") / F.lit(tile[0])).cast("int"),
                            "blocks": F.ceil(F.col("sources") / F.lit(tile[0])).cast("int"),
                            "buckets": F.greatest(F.lit(1), F.ceil(F.col("v") / F.lit(tile[1]))).cast("int")}))
    groups = cut(groups)
    shared = cut(terms.join(groups, ["lang", "source"]).withColumns(
        {"p": _share("n", "n_source", "v"), "q": _share("n_term", "n_lang", "v")})
        .select("lang", "source", "no", "block", "blocks", "buckets", "term", "p", "q"))

    value = (F.col("p") - F.col("q")).cast("bigint")
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    best = (shared.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
            .withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top))
    pairs = _pairs(shared, groups, tile[0]).withColumn("rank", F.row_number().over(by_value))
    cols = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(cols).union(best.select(cols))


def _pairs(shared: DataFrame, groups: DataFrame, tile_sources: int) -> DataFrame:
    """Summed distances of all ordered pairs of a language's sources: tiles of sources by terms, added up."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tile = [F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")]
    some = (shared.select("lang", "block", other, F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int").alias("bucket"), "no", "term", "p")
            .select("lang", *tile, "bucket", "no", "term", "p"))
    # each source also has its probability of terms it does not hold, once per tile
    none = (groups.select("lang", "block", other, "buckets", "no", "p0")
            .select("lang", *tile, F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"),
                    "no", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p")))

    def distances(key: tuple, t: pa.Table) -> pa.Table:
        no, p = t.column("no").to_numpy(), t.column("p").fill_null(0).to_numpy()
        term = t.column("term").combine_chunks()
        base = term.is_null().to_numpy(zero_copy_only=False)
        members = np.sort(no[base])
        p0 = np.zeros(len(members), np.int64)
        p0[np.searchsorted(members, no[base])] = p[base]
        coded = term.filter(pa.array(~base)).dictionary_encode()
        dense = np.repeat(p0[:, None], len(coded.dictionary), axis=1)
        dense[np.searchsorted(members, no[~base]), coded.indices.to_numpy()] = p[~base]
        side = members // tile_sources
        left, right = np.flatnonzero(side == key[1].as_py()), np.flatnonzero(side == key[2].as_py())
        a, b, f = [], [], []
        for x in left.tolist():
            ys = right[right > x]
            a.append(np.full(len(ys), members[x]))
            b.append(members[ys])
            f.append(np.abs(dense[ys] - dense[x]).sum(axis=1))
        flat = [np.concatenate(v) if v else np.empty(0, np.int64) for v in (a, b, f)]
        return pa.table({"lang": pa.array([key[0].as_py()] * len(flat[0]), pa.string()), "a": pa.array(flat[0], pa.int64()),
                         "b": pa.array(flat[1], pa.int64()), "f": pa.array(flat[2], pa.int64()),
                         "seen": pa.array([len(coded.dictionary)] * len(flat[0]), pa.int64())})

    parts = some.unionByName(none).groupBy("lang", "lo", "hi", "bucket").applyInArrow(
        distances, "lang string, a bigint, b bigint, f bigint, seen bigint")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("f").alias("f"), F.sum("seen").alias("seen"))
    ends = groups.select("lang", F.col("no").cast("bigint").alias("no"), "source", "p0", "v")
    sums = (sums.join(ends.select("lang", F.col("no").alias("a"), F.col("source").alias("source_a"), F.col("p0").alias("p0_a"), "v"), ["lang", "a"])
            .join(ends.select("lang", F.col("no").alias("b"), F.col("source").alias("source_b"), F.col("p0").alias("p0_b")), ["lang", "b"]))
    # terms that no source of a tile holds
    unseen = F.coalesce((F.col("v") - F.col("seen")) * F.abs(F.col("p0_a") - F.col("p0_b")), F.lit(0))
    both = F.explode(F.array(*[F.struct(F.col(f"source_{x}").alias("source"), F.col(f"source_{y}").alias("item")) for x, y in ("ab", "ba")]))
    return (sums.select("lang", both.alias("e"), (F.col("f") + unseen).cast("bigint").alias("value"))
            .select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value"))

"""Exact Jaccard self-join of documents on word shingles with count-vector R-trees.

A document's set is its distinct k-word shingles (64-bit hashes).  Equal sets form
one class, so exact copies cost one point.  Shingles are hashed into groups; the
number of shingles per group is the class's point.  For two points the overlap of
the sets is at most the sum of the coordinate minima, and for two boxes at most
the sum of the minima of their upper corners: an R-tree over the points prunes
whole nodes, then single pairs, and what is left is verified on the sets.

Work is dealt out like this:

1. one pass counts shingles in a table of hash buckets that grows with the texts (an
   order from rare to frequent that every task shares; any order keeps the join exact);
2. each set's rarest ``n - ceil(t n) + l`` shingles are its prefix: two unlike sets with
   similarity ``t`` share ``l`` shingles of both prefixes (``least_shared``).  Prefix rows
   meet by shingle (56 bits of it) and by size;
3. a shingle of few classes gives its pairs; those met ``l`` times are pruned by the
   points' bound.  A shingle of many classes only ties them to the first of their size
   band.  Components of these ties are neighbourhoods that no linked pair can leave;
4. each neighbourhood, cut into tiles of bounded size, is joined through an R-tree
   per task; verified links (a spanning forest of them) give the components.

Nulls and texts without words have an empty set, linked with nothing.  Repeated
rows are copies like any other.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import words as W
from cadenza.llm.components import components
from cadenza.llm.shared import added_up, cut, give_back, giving_back, landed, may_hold, shuffle_width, signed, text_key

SHINGLE = 5
#: A link is ``100 * intersection >= 75 * union``.
NUM, DEN = 75, 100
#: Bytes of text for a bucket of the shingle-frequency table, and that table's least and most bits (32 MB on the driver and in
#: each worker, four times that in a task that counts).
BUCKET_BYTES = 800
LEAST_BUCKET_BITS, MOST_BUCKET_BITS = 16, 25
#: The low bits of a prefix shingle hold the band of its set's size.
BAND_BITS = 8
#: Groups of the points that a task compares (coarser points only prune less).
MAX_GROUPS = 1 << 14
#: A prefix shingle of more classes than this only ties them to one neighbourhood.
SMALL_BLOCK = 32
#: Classes in a tile; a task holds the sets of two tiles.
TILE = 384
LEAF = 32
#: Shingles of a task's sets from which its memory is given back at once.
GIVE_BACK = 1 << 18


# ---- sets, points, prefixes ------------------------------------------------------

def shingles_of(column: pa.Array, k: int = SHINGLE):
    """``(row, all shingle hashes)`` of every text (repeats kept); short texts give one shingle."""
    for at, to, buf, off in W.text_blocks(column):
        w = W.words(buf, off, W.NOT_SPACE)
        g = W.ngrams(w.hash, k)
        for i in range(to - at):
            lo, hi = int(w.bounds[i]), int(w.bounds[i + 1])
            if hi - lo >= k:
                yield at + i, g[lo: hi - k + 1]
            else:
                yield at + i, W.ngrams(w.hash[lo:hi], max(1, hi - lo))


def groups_for(n: int) -> int:
    """Groups of a set of ``n`` shingles: a power of two, 64 at least and about ``n / 8``."""
    return max(64, 1 << max(0, (n // 8 - 1).bit_length()))


def point_of(s: np.ndarray, groups: int) -> np.ndarray:
    """Count vector of a set: its shingles per group (groups are hash ranges, so they fold)."""
    shift = np.uint64(64 - (groups.bit_length() - 1))
    return np.bincount((s >> shift).astype(np.int64), minlength=groups).astype(np.int32)


def packed_point(point: np.ndarray) -> bytes:
    """A point in the fewest bytes a coordinate."""
    return point.astype(np.min_scalar_type(int(point.max()))).tobytes()


def unpacked_point(data, n: int) -> np.ndarray:
    """The point of a set of ``n`` shingles."""
    return np.frombuffer(data, f"u{len(data) // groups_for(n)}")


def fold(point: np.ndarray, groups: int) -> np.ndarray:
    return point.reshape(groups, -1).sum(axis=1)


def overlap_bound(p: np.ndarray, q: np.ndarray) -> int:
    """The most shingles that two sets with these points can share."""
    g = min(len(p), len(q))
    return int(np.minimum(fold(p, g), fold(q, g)).sum())


def least_overlap(a, b, num: int = NUM, den: int = DEN):
    """Fewest common shingles of two linked sets of sizes ``a`` and ``b`` (works on arrays)."""
    return -(-num * (a + b) // (num + den))


def _set_key(s: np.ndarray) -> np.uint64:
    return W.mix(np.array([W.mix(s).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64))[0]


def bucket_bits(docs: DataFrame) -> int:
    """Bits of a bucket's number: a bucket has about 64 to 128 shingles at any size of the table, up to ``MOST_BUCKET_BITS``.

    In fuller buckets a shingle of many documents looks as rare as any other.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(MOST_BUCKET_BITS, max(LEAST_BUCKET_BITS, (size // BUCKET_BYTES).bit_length()))


def bucket_ranks(docs: DataFrame, k: int) -> np.ndarray:
    """Shingles of the whole table per hash bucket as a byte, ``11 log2(1 + count)``: tasks count, Spark adds the tables up."""
    bits = bucket_bits(docs)

    def count(batches):
        seen = np.zeros(1 << bits, np.uint32)
        for b in batches:
            for at, to, buf, off in W.text_blocks(b.column(0)):
                w = W.words(buf, off, W.NOT_SPACE)
                g = W.ngrams(w.hash, k)[W.inside_rows(w.bounds, k)]
                bucket, n = np.unique(g >> np.uint64(64 - bits), return_counts=True)
                seen[bucket.astype(np.int64)] += n.astype(np.uint32)
        return seen

    def rank(totals):
        return np.minimum(255, np.rint(11 * np.log2(1.0 + totals))).astype(np.uint8)

    # each task sends a whole table, so their number must not grow with it
    few = docs.select("text").coalesce(max(64, docs.sparkSession.sparkContext.defaultParallelism))
    return added_up(few, count, np.int64, np.add, rank)


def least_shared(num: int = NUM, den: int = DEN) -> int:
    """Prefix shingles that two unlike linked sets must share, 3 at most: sets that share fewer reach no more than ``(l - 1) / l``."""
    return max(x for x in (1, 2, 3) if den * (x - 1) < num * x)


def band_of(n: np.ndarray, num: int = NUM, den: int = DEN) -> np.ndarray:
    """Sizes by powers of ``den / num``: linked sets are of one band or of neighbouring ones."""
    step = max(np.log(den / num), 0.05) * (1 + 1e-9)
    return np.minimum(255, np.floor(np.log(np.maximum(n, 1)) / step)).astype(np.int64)


# ---- tiles: the R-tree join -------------------------------------------------------

class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def tie(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def pack_leaves(points: np.ndarray, sizes: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Leaves of an R-tree by sort-tile packing: slabs by set size, then by the coordinate that varies most."""
    order = np.argsort(sizes, kind="stable")
    slab = leaf * max(1, int(np.ceil(np.sqrt(len(order) / leaf))))
    leaves = []
    for i in range(0, len(order), slab):
        part = order[i: i + slab]
        axis = int(points[part].var(axis=0).argmax())
        part = part[np.argsort(points[part, axis], kind="stable")]
        leaves += [part[j: j + leaf] for j in range(0, len(part), leaf)]
    return leaves


def join_sets(sets: list[np.ndarray], side: np.ndarray | None = None, num: int = NUM, den: int = DEN) -> list[tuple[int, int]]:
    """A spanning forest of the linked pairs of ``sets`` (sorted, distinct shingles).

    ``side``: with two kinds of entries (0, 1), only pairs of unlike entries are looked at.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    groups = min(MAX_GROUPS, groups_for(int(sizes.max()) if n else 1))
    points = np.stack([point_of(s, groups) for s in sets]) if n else np.empty((0, groups), np.int32)
    leaves = pack_leaves(points, sizes)
    top = [points[x].max(axis=0) for x in leaves]
    low = [int(sizes[x].min()) for x in leaves]
    forest, links = _Forest(n), []
    # shingles of two sets at least, as columns of small 0/1 matrices
    every = np.concatenate(sets) if n else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    values, column, count = np.unique(every, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], (np.cumsum(count > 1) - 1)[column[shared]]
    first = np.searchsorted(owner, np.arange(n + 1))

    def overlaps(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        mine = [column[first[i]: first[i + 1]] for i in x]
        theirs = [column[first[i]: first[i + 1]] for i in y]
        cols = np.intersect1d(np.concatenate(mine), np.concatenate(theirs))
        out = np.zeros((len(x), len(y)), np.float32)
        for c in range(0, len(cols), 8192):
            part = cols[c: c + 8192]

            def matrix(rows):
                m = np.zeros((len(rows), len(part)), np.float32)
                for r, v in enumerate(rows):
                    at = np.searchsorted(part, v)
                    at[at == len(part)] = 0
                    m[r, at[part[at] == v]] = 1
                return m
            out += matrix(mine) @ matrix(theirs).T
        return out.astype(np.int64)

    for i in range(len(leaves)):
        for j in range(i + 1):
            # of sizes at least a and b, the least overlap is smallest for a and b themselves
            if np.minimum(top[i], top[j]).sum() < least_overlap(low[i], low[j], num, den):
                continue
            x, y = leaves[i], leaves[j]
            need = least_overlap(sizes[x][:, None], sizes[y][None, :], num, den)
            open_ = (np.minimum(sizes[x][:, None], sizes[y][None, :]) >= need)
            if i == j:
                open_ &= np.tri(len(x), len(y), -1, dtype=bool)
            if side is not None:
                open_ &= side[x][:, None] != side[y][None, :]
            for r in np.flatnonzero(open_.any(axis=1)):
                bound = np.minimum(points[x[r]][None, :], points[y]).sum(axis=1)
                open_[r] &= bound >= need[r]
            if not open_.any():
                continue
            rx = np.array([forest.root(v) for v in x.tolist()])
            ry = np.array([forest.root(v) for v in y.tolist()])
            open_ &= rx[:, None] != ry[None, :]
            rows, cols = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
            if not len(rows):
                continue
            got = np.zeros_like(open_)
            got[np.ix_(rows, cols)] = overlaps(x[rows], y[cols]) >= need[np.ix_(rows, cols)]
            for r, c in zip(*np.nonzero(got & open_), strict=True):
                if forest.tie(int(x[r]), int(y[c])):
                    links.append((int(x[r]), int(y[c])))
    return links


# ---- the operator ------------------------------------------------------------------

def jaccard_components(docs: DataFrame, k: int = SHINGLE, num: int = NUM, den: int = DEN,
                       small_block: int = SMALL_BLOCK, tile: int = TILE) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, root`` of each row of ``docs`` (``doc_id``, ``text``).

    ``component_id``: the smallest doc_id reachable over links of similarity
    ``num / den`` or more, the row's own included.  A null doc_id is never the smallest.
    ``root`` tells components apart (one of its classes, null without words): unlike texts
    without ids, or of one id, have equal ``component_id`` but not equal roots.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    ranks = spark.sparkContext.broadcast(bucket_ranks(docs, k))
    share = least_shared(num, den)

    def describe(batches):
        rank = ranks.value
        shift = np.uint64(64 - (len(rank).bit_length() - 1))
        low = np.int64((1 << BAND_BITS) - 1)
        for b in batches:
            n, key, point, prefix = [], [], [], []
            for _, g in shingles_of(b.column("text"), k):
                s = np.unique(g)
                n.append(len(s))
                key.append(_set_key(s))
                if not len(s):
                    point.append(b"")
                    prefix.append(np.empty(0, np.int64))
                    continue
                point.append(packed_point(point_of(s, groups_for(len(s)))))
                p = len(s) - (-(-num * len(s) // den)) + share
                rare = rank[(s >> shift).astype(np.int64)]
                # rank by (count, hash): s is sorted, so a stable sort by count is enough
                first = signed(s[np.argsort(rare, kind="stable")[:p]])
                prefix.append(first & ~low | band_of(np.array([len(s)]), num, den)[0])
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("text_key"), pa.array(n, pa.int64()),
                pa.array(signed(np.array(key, np.uint64)), pa.int64()), pa.array(point, pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*prefix, np.empty(0, np.int64)])))],
                names=["doc_id", "text_key", "n_shingles", "class", "point", "prefix"])

    described = docs.withColumn("text_key", text_key(F.col("text"))).mapInArrow(
        giving_back(describe), "doc_id bigint, text_key bigint, n_shingles bigint, class bigint, point binary, prefix array<bigint>")
    described = landed(described, "jaccard-points")
    ranks.destroy()

    ties = _ties(described, small_block, num, den)
    hoods = landed(components(ties).select(F.col("node").alias("class"), F.col("root").alias("hood")), "jaccard-hoods")
    links = _links(docs, described, hoods, k, num, den, tile)
    parts = components(links).select(F.col("node").alias("class"), "root")

    # smallest doc_id of a class, then of a component
    classes = described.filter("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("first_id"))
    named = classes.join(parts, "class", "left").select("class", F.coalesce("root", "class").alias("root"), "first_id")
    # checkpointed, so that the join shuffles both sides and a large component's classes can be split
    tops = cut(named.groupBy("root").agg(F.min("first_id").alias("component_id")))
    named = named.join(tops, "root").select("class", "component_id", "root")
    rows = described.select("doc_id", "text_key", "n_shingles", "class")
    with_words = rows.filter("n_shingles > 0").join(named, "class", "left")
    without = rows.filter("n_shingles = 0").withColumns({"component_id": F.col("doc_id"), "root": F.lit(None).cast("bigint")})
    cols = ["doc_id", "text_key", "n_shingles", "component_id", "root"]
    return with_words.select(cols).union(without.select(cols))


def _ties(described: DataFrame, small_block: int, num: int, den: int) -> DataFrame:
    """Edges ``(a, b)`` between classes: pairs of small blocks that pass the points' bound, ties of large ones.

    A block holds the classes of one prefix shingle whose size bands follow one another without a gap.  Linked classes share
    ``least_shared`` prefix shingles, so they meet as a pair in as many small blocks, or are tied in a large one.
    """
    spark = described.sparkSession
    rows = described.filter("n_shingles > 0").select(F.explode("prefix").alias("shingle"), "class")
    rows = rows.repartition(shuffle_width(spark), F.shiftright("shingle", BAND_BITS)).sortWithinPartitions("shingle", "class")
    low = (1 << BAND_BITS) - 1

    def meet(batches):
        at, top, members, spilled, last, head = None, 0, [], False, None, None
        out_a, out_b, out_s = [], [], []

        def edge(y, x, pair):
            out_a.append(y)
            out_b.append(x)
            out_s.append(pair)

        def close():
            if not spilled:
                for i, (x, p) in enumerate(members):
                    for y, q in members[:i]:
                        if p - q <= 1:
                            edge(y, x, True)

        def tie(x, band):  # to the first class of its band, which is tied to the one of the band before
            nonlocal head
            if head is None or head[1] != band:
                if head is not None:
                    edge(head[0], x, False)
                head = (x, band)
            else:
                edge(head[0], x, False)

        for b in batches:
            key = b.column(0).to_numpy()
            cl = b.column(1).to_numpy()
            # runs of one class are passed over quickly
            n = len(key)
            if not n:
                continue
            sh, bands = key >> BAND_BITS, key & low
            same = np.zeros(n, bool)
            same[1:] = (sh[1:] == sh[:-1]) & (bands[1:] - bands[:-1] <= 1)
            nxt = np.ones(n, bool)
            nxt[:-1] = same[1:]
            busy = same | nxt  # others of its block are in this batch (or may follow)
            busy[0] = True
            for i in np.flatnonzero(busy).tolist():
                s, band, c = int(sh[i]), int(bands[i]), int(cl[i])
                if s != at or band - top > 1:
                    close()
                    at, members, spilled, last, head = s, [(c, band)], False, c, None
                elif c != last:
                    last = c
                    if spilled:
                        tie(c, band)
                    else:
                        members.append((c, band))
                        if len(members) > small_block:
                            spilled = True
                            for x, p in members:
                                tie(x, p)
                top = band
            if len(out_a) > 20000:
                yield _edge_batch(out_a, out_b, out_s)
                out_a, out_b, out_s = [], [], []
        close()
        if out_a:
            yield _edge_batch(out_a, out_b, out_s)

    # a pair is the same way round in every block: the class of the smaller band, then the smaller class, comes first
    edges = rows.mapInArrow(giving_back(meet), "a bigint, b bigint, pair boolean").groupBy("a", "b").agg(
        F.min("pair").alias("pair"), F.count(F.lit(1)).alias("shared"))
    edges = landed(edges.filter(~F.col("pair") | (F.col("shared") >= least_shared(num, den))), "jaccard-edges")
    points = described.filter("n_shingles > 0").select("class", "n_shingles", "point")
    ends = edges.filter("pair").select(F.explode(F.array("a", "b")).alias("class")).distinct()
    # grouped before the join, so the rows of a much copied class are put together where they are read
    points = points.groupBy("class").agg(F.max("n_shingles").alias("n"), F.max("point").alias("point"))
    points = landed(points.join(ends, "class"), "jaccard-ends")
    pairs = (edges.filter("pair")
             .join(points.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa")), "a")
             .join(points.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb")), "b"))

    def bounded(batches):
        for b in batches:
            na, nb = b.column("na").to_numpy(), b.column("nb").to_numpy()
            need = least_overlap(na, nb, num, den)
            keep = [overlap_bound(unpacked_point(x.as_buffer(), m), unpacked_point(y.as_buffer(), n)) >= t
                    for x, y, m, n, t in zip(b.column("pa"), b.column("pb"), na.tolist(), nb.tolist(), need.tolist(), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = pairs.filter(F.least("na", "nb") * den >= F.greatest("na", "nb") * num)
    return landed(edges.filter("not pair").select("a", "b").union(pairs.mapInArrow(giving_back(bounded), "a bigint, b bigint")), "jaccard-ties")


def _edge_batch(a, b, pair) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(pair, pa.bool_())],
                                      names=["a", "b", "pair"])


def _links(docs: DataFrame, described: DataFrame, hoods: DataFrame, k: int, num: int, den: int, tile: int) -> DataFrame:
    """Verified links ``(a, b)`` between classes, a spanning forest of each pair of tiles."""
    tiles = hoods.groupBy("hood").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("tiles"))
    # one document stands for each class; its text is read again for the set
    reps = (described.filter("n_shingles > 0").groupBy("class").agg(F.min(F.struct("doc_id", "text_key")).alias("rep"))
            .join(hoods, "class").join(tiles, "hood").select("class", "hood", "tiles", "rep.doc_id", "rep.text_key"))
    reps = landed(reps, "jaccard-reps")
    texts = docs.withColumn("text_key", text_key(F.col("text")))
    # few texts are asked for: the others stay out of the shuffle
    row_key = F.xxhash64("doc_id", "text_key")
    texts = texts.filter(may_hold(reps.select(row_key))(row_key))
    on = texts.doc_id.eqNullSafe(reps.doc_id) & (texts.text_key == reps.text_key)
    chosen = texts.join(reps, on).select("class", "hood", "tiles", "text")

    def sets_of(batches):
        last = None
        for b in batches:
            # repeated rows stand next to one another after the join: one is enough
            ids = b.column("class").to_numpy()
            new = np.ones(len(ids), bool)
            new[1:] = ids[1:] != ids[:-1]
            if len(ids):
                new[0] = ids[0] != last
                last = ids[-1]
            b = b.filter(pa.array(new))
            sets = [np.unique(g).tobytes() for _, g in shingles_of(b.column("text"), k)]
            yield pa.RecordBatch.from_arrays([b.column("class"), b.column("hood"), b.column("tiles"), pa.array(sets, pa.binary())],
                                             names=["class", "hood", "tiles", "shingles"])

    sets = chosen.mapInArrow(giving_back(sets_of), "class bigint, hood bigint, tiles int, shingles binary")
    own = F.pmod(F.xxhash64("class"), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    placed = (sets.withColumn("own", own).withColumn("other", other)
              .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
              .select("hood", "lo", "hi", "class", "own", "shingles"))

    def join_tile(key: tuple, t: pa.Table) -> pa.Table:
        ids = t.column("class").to_numpy()
        _, keep = np.unique(ids, return_index=True)  # a repeated document row
        t, ids = t.take(keep), ids[keep]
        own = t.column("own").to_numpy()
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in t.column("shingles")]
        side = None if key[1].as_py() == key[2].as_py() else (own == key[1].as_py()).astype(np.int8)
        found = join_sets(sets, side, num, den)
        if sum(len(s) for s in sets) > GIVE_BACK:
            give_back()
        return pa.table({"a": pa.array([int(ids[x]) for x, _ in found], pa.int64()),
                         "b": pa.array([int(ids[y]) for _, y in found], pa.int64())})

    return landed(placed.groupBy("hood", "lo", "hi").applyInArrow(join_tile, "a bigint, b bigint"), "jaccard-links")

"""Token ids of whole documents, packed into fixed-length rows by best-fit decreasing.

Texts become ids of a public byte-level tokenizer (path given); ids longer than a
row are split into pieces without loss.  Pieces are packed by best-fit decreasing:
longest first, each into the fullest row that still has room, which a segment tree
over the rows' free capacities finds in logarithmic time.  Rows come out as id
matrices (little-endian binary, row-major) with each row's cumulative segment
lengths and position ids that start again at 0 with every segment.

A task packs its own documents, some millions of ids at a time: nothing is shuffled,
and a task holds one such batch.  The same input files and splits give the same
matrices.  Null and empty texts have no ids and take no room; repeated rows are
packed once each (``doc_row`` tells them apart).  An empty table gives no matrices.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cadenza.llm import words as W
from cadenza.llm.shared import giving_back

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that belongs to the vocabulary files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_OF_TEXT = 50256
SEQ_LEN = 2048
MATRIX_ROWS = 64
#: Ids that a task gathers before it packs them.
BATCH_IDS = 4 << 20
#: Encoded words that a worker remembers.
CACHE_WORDS = 1 << 16

SCHEMA = ("matrix_id bigint, n_rows int, seq_len int, id_bytes int, ids binary, position_ids binary, "
          "row_segments array<int>, cu_seqlens array<int>, "
          "pieces array<struct<doc_id:bigint,doc_row:bigint,start:bigint,length:int>>")


class SegmentTree:
    """Which free capacities 0..size occur: leaf c counts the rows with c ids of room."""

    def __init__(self, size: int):
        self.base = 1 << size.bit_length()
        self.count = [0] * (2 * self.base)

    def add(self, c: int, by: int) -> None:
        i = c + self.base
        while i:
            self.count[i] += by
            i >>= 1

    def least(self, c: int) -> int | None:
        """The smallest capacity of ``c`` or more that some row has."""
        i = c + self.base
        if self.count[i]:
            return c
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.base:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.base
            i >>= 1
        return None


def best_fit_decreasing(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Rows of piece indexes; equal lengths go in input order, equal rooms to the row that got it last."""
    order = np.argsort(-lengths, kind="stable")
    tree, rooms, rows = SegmentTree(size), [[] for _ in range(size + 1)], []
    for i in order.tolist():
        n = int(lengths[i])
        c = tree.least(n)
        if c is None:
            r, c = len(rows), size
            rows.append([])
        else:
            r = rooms[c].pop()
            tree.add(c, -1)
        rows[r].append(i)
        if c - n > 0:
            rooms[c - n].append(r)
            tree.add(c - n, 1)
    return rows


class Encoder:
    """Ids of texts; each distinct word of a block is encoded once.

    A word here begins at a space that follows something else than white space; the
    split pattern always cuts there, so words can be encoded one by one.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        import tiktoken

        self.encoding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[bytes, list[int]] = {}

    def encode_word(self, word: bytes) -> list[int]:
        ids = self.known.get(word)
        if ids is None:
            ids = self.encoding.encode_ordinary(word.decode("utf-8", "replace"))
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            if len(word) <= 64:
                self.known[word] = ids
        return ids

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block of texts, and each row's bounds in them."""
        n = len(buf)
        if n == 0:
            return np.empty(0, np.int32), np.zeros(len(off), np.int64)
        cut = np.zeros(n, bool)
        cut[1:] = (buf[1:] == 0x20) & W.NOT_SPACE[buf[:-1]] & (buf[:-1] > 0x1F)
        # a space that is not ASCII may stand before it: two bytes after C2, three after E1 to E3
        cut[2:] &= ~((buf[:-2] == 0xC2) & ((buf[1:-1] == 0x85) | (buf[1:-1] == 0xA0)))
        cut[3:] &= ~((buf[:-3] >= 0xE1) & (buf[:-3] <= 0xE3) & (buf[1:-2] >= 0x80) & (buf[1:-2] < 0xC0))
        cut[off[:-1][np.diff(off) > 0]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], n)
        value, first, which = np.unique(W._hash_spans(buf, start, end), return_index=True, return_inverse=True)
        which = self._told_apart(buf, start, end, first, which)
        if which is None:  # two words with one hash: take every word by itself
            first, which = np.arange(len(start)), np.arange(len(start))
        raw = buf.tobytes()
        got = [self.encode_word(raw[s:e]) for s, e in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        length = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter((i for ids in got for i in ids), np.int32, int(length.sum()))
        place = np.concatenate([[0], np.cumsum(length)])[:-1]
        each = length[which]
        upto = np.concatenate([[0], np.cumsum(each)])
        ids = flat[np.repeat(place[which] - upto[:-1], each) + np.arange(int(upto[-1]))]
        return ids, upto[np.searchsorted(start, off)]

    @staticmethod
    def _told_apart(buf, start, end, first, which):
        """``which`` if every word equals the first word of its hash, byte by byte; else None."""
        length = end - start
        if (length != length[first][which]).any():
            return None
        total = np.concatenate([[0], np.cumsum(length)])
        at = 0
        while at < len(start):
            to = min(len(start), max(at + 1, int(np.searchsorted(total, total[at] + W.HASH_BYTES, side="right")) - 1))
            n = length[at:to]
            pos = np.arange(int(n.sum())) - np.repeat(total[at:to] - total[at], n)
            if (buf[np.repeat(start[at:to], n) + pos] != buf[np.repeat(start[first[which[at:to]]], n) + pos]).any():
                return None
            at = to
        return which


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) }


_encoders: dict[int, Encoder] = {}  # of this worker, by broadcast id


def packed(docs: DataFrame, tokenizer: str = TOKENIZER, seq_len: int = SEQ_LEN, end_id: int | None = END_OF_TEXT,
           pad_id: int = END_OF_TEXT, matrix_rows: int = MATRIX_ROWS, batch_ids: int = BATCH_IDS) -> DataFrame:
    """Id matrices of all documents (``doc_id``, ``text``), columns as in ``SCHEMA``.

    ``ids`` and ``position_ids`` hold ``n_rows * seq_len`` unsigned integers of
    ``id_bytes`` bytes.  Every document ends with ``end_id`` (None: nothing is added).
    Row by row, ``row_segments`` has the number of segments, ``cu_seqlens`` the row's
    cumulative segment lengths (one value more than segments, from 0) and ``pieces``
    which ids (``start:start + length``) of which document each segment holds.  The
    rest of a row is ``pad_id``.
    """
    ranks = read_ranks(tokenizer)  # a vocabulary file of some MB, read once by the driver
    top = max([*ranks.values(), pad_id, end_id or 0])
    kind = np.dtype("<u2") if max(top, seq_len) < 1 << 16 else np.dtype("<u4")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    key = shared.id if hasattr(shared, "id") else id(shared)

    def run(batches: Iterator[pa.RecordBatch]):
        if key not in _encoders:
            _encoders.clear()
            _encoders[key] = Encoder(shared.value)
        encoder = _encoders[key]
        place = TaskContext.get().partitionId() << 33
        n_docs = n_matrices = held = 0
        texts: list[tuple[int | None, int, np.ndarray]] = []

        def flush():
            nonlocal n_matrices, held, texts
            pieces = [(d, r, s, ids[s: s + seq_len]) for d, r, ids in texts for s in range(0, len(ids), seq_len)]
            rows = best_fit_decreasing(np.array([len(p[3]) for p in pieces], np.int64), seq_len)
            for at in range(0, len(rows), matrix_rows):
                part = rows[at: at + matrix_rows]
                ids = np.full((len(part), seq_len), pad_id, kind)
                pos = np.zeros((len(part), seq_len), kind)
                cu, told = [], []
                for r, row in enumerate(part):
                    ends = [0]
                    for i in row:
                        a, z = ends[-1], ends[-1] + len(pieces[i][3])
                        ids[r, a:z], pos[r, a:z] = pieces[i][3], np.arange(z - a)
                        ends.append(z)
                    cu += ends
                    told += [{"doc_id": pieces[i][0], "doc_row": pieces[i][1], "start": pieces[i][2], "length": len(pieces[i][3])} for i in row]
                yield pa.RecordBatch.from_arrays([
                    pa.array([place + n_matrices], pa.int64()), pa.array([len(part)], pa.int32()), pa.array([seq_len], pa.int32()),
                    pa.array([kind.itemsize], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([pos.tobytes()], pa.binary()),
                    pa.array([[len(row) for row in part]], pa.list_(pa.int32())), pa.array([cu], pa.list_(pa.int32())),
                    pa.array([told], pa.list_(pa.struct([("doc_id", pa.int64()), ("doc_row", pa.int64()), ("start", pa.int64()), ("length", pa.int32())])))],
                    names=["matrix_id", "n_rows", "seq_len", "id_bytes", "ids", "position_ids", "row_segments", "cu_seqlens", "pieces"])
                n_matrices += 1
            texts, held = [], 0

        end = [] if end_id is None else [end_id]
        for b in batches:
            doc_ids = b.column("doc_id").to_pylist()
            for at, to, buf, off in W.text_blocks(b.column("text")):
                ids, bounds = encoder.encode(buf, off)
                ids = ids.astype(kind)
                for i in range(to - at):
                    own = ids[bounds[i]: bounds[i + 1]]
                    if len(own):
                        texts.append((doc_ids[at + i], place + n_docs, np.concatenate([own, np.array(end, kind)]) if end else own.copy()))
                        held += len(own) + len(end)
                    n_docs += 1
                    if held >= batch_ids:
                        yield from flush()
        yield from flush()
        encoder.known.clear()

    return docs.select("doc_id", "text").mapInArrow(giving_back(run), SCHEMA)


def segments(matrices: DataFrame) -> DataFrame:
    """``doc_id, doc_row, start, ids`` (array of int) of every segment, read back from the matrices."""
    def run(batches):
        for b in batches:
            for m in b.to_pylist():
                kind = np.dtype("<u2") if m["id_bytes"] == 2 else np.dtype("<u4")
                ids = np.frombuffer(m["ids"], kind).reshape(m["n_rows"], m["seq_len"])
                rows, at = [], 0
                for r, n in enumerate(m["row_segments"]):
                    cu = m["cu_seqlens"][at + r: at + r + n + 1]
                    rows += [(p["doc_id"], p["doc_row"], p["start"], ids[r, cu[j]: cu[j + 1]].astype(np.int32))
                             for j, p in enumerate(m["pieces"][at: at + n])]
                    at += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int64()),
                     pa.array([x[2] for x in rows], pa.int64()), pa.array([x[3] for x in rows], pa.list_(pa.int32()))],
                    names=["doc_id", "doc_row", "start", "ids"])
    return matrices.mapInArrow(run, "doc_id bigint, doc_row bigint, start bigint, ids array<int>")

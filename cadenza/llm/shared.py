"""Small helpers of the operators in this folder."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.session import checkpoint_dir, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that is written or collected inside go when it ends, not when the driver's garbage is collected."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def landed(df: DataFrame, name: str) -> DataFrame:
    """``written``, and the shuffle files of ``df`` freed."""
    with shuffles_freed(df.sparkSession):
        return written(df, name)


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint (rows, their order and partitions are kept)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def long_or_null(values: Sequence[int | None]) -> pa.Array:
    return pa.array(values, pa.int64())


def signed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's signed longs (same bits)."""
    return h.view(np.int64)


def give_back() -> None:
    """Return a task's freed memory to the system, so that an idle Python worker does not hold it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library: nothing to trim
        pass


def giving_back(work: Callable) -> Callable:
    """``work`` over a task's batches; what it held is given back when it has ended and its last batch is let go."""
    def run(batches):
        yield from work(batches)
        give_back()
    return run


def text_key(text: Column) -> Column:
    """A 64-bit key of a text that tells null from empty."""
    return F.when(text.isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64(text))


#: Entries of a table of fixed size that make one row of a shuffle.
_CHUNK = 1 << 12


def added_up(df: DataFrame, fill: Callable, dtype: type, add: np.ufunc, finish: Callable | None = None) -> np.ndarray:
    """One table (a multiple of 4,096 entries): ``fill`` makes it of each task's batches, Spark joins them with ``add``.

    ``finish`` is applied to the joined entries, in tasks.  Only parts that are not zero are sent.
    """
    def sent(chunks):
        for c, part in chunks:
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([part.tobytes()], pa.binary()),
                                                  pa.array([part.dtype.str])], names=["chunk", "entries", "kind"])

    def tables(batches):
        seen = fill(batches)
        small = [(c, seen[c * _CHUNK: (c + 1) * _CHUNK]) for c in range(len(seen) // _CHUNK)]
        yield from sent((c, part.astype(np.min_scalar_type(int(part.max())))) for c, part in small)

    def joined(batches):
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for c, v, kind in zip(b.column("chunk").to_pylist(), b.column("entries"), b.column("kind").to_pylist(), strict=True):
                part = np.frombuffer(v.as_buffer(), kind).astype(dtype)
                totals[c] = add(totals[c], part) if c in totals else part
        yield from sent((c, finish(v) if finish else v) for c, v in totals.items())

    row = "chunk int, entries binary, kind string"
    size = len(fill([]))
    parts = df.mapInArrow(giving_back(tables), row).repartition(min(shuffle_width(df.sparkSession), size // _CHUNK), "chunk")
    with shuffles_freed(df.sparkSession):
        rows = parts.mapInArrow(joined, row).collect()
    kinds = {kind for _, _, kind in rows} or {np.dtype(dtype).str}
    out = np.zeros(size, kinds.pop())
    for c, v, _ in rows:
        out[c * _CHUNK: (c + 1) * _CHUNK] = np.frombuffer(bytes(v), out.dtype)
    return out


def may_hold(keys: DataFrame, most_bits: int = 27) -> Callable[[Column], Column]:
    """A test for ``keys`` (one column of 64-bit hashes): true for each of them, and for few others (a Bloom filter).

    About 16 bits a key, 2 ** ``most_bits`` at most: beyond, more of the others pass.
    """
    spark = keys.sparkSession
    bits = min(most_bits, max(15, (16 * keys.count()).bit_length()))

    def places(v: np.ndarray) -> list[np.ndarray]:
        h = v.view(np.uint64)
        return [(x & np.uint64((1 << bits) - 1)).astype(np.int64) for x in (h, h >> np.uint64(32))]

    def mark(batches):
        seen = np.zeros(1 << bits, bool)
        for b in batches:
            for at in places(b.column(0).to_numpy()):
                seen[at] = True
        return np.packbits(seen)

    held = spark.sparkContext.broadcast(added_up(keys, mark, np.uint8, np.bitwise_or))

    @F.arrow_udf("boolean")
    def holds(key: pa.Array) -> pa.Array:
        x, y = [(held.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 for at in places(key.to_numpy())]
        return pa.array((x & y).astype(bool))

    return holds


def prefix_sums(df: DataFrame, order: Sequence[Column], value: str, out: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over all rows before this one in ``order``.

    Rows are range-partitioned and sorted once into a checkpoint; each partition's
    total becomes the next one's offset (one number per partition on the driver),
    and every task adds up its own rows in a stream.  ``order`` should split hot
    keys (end it with a hash), as equal rows stay in one partition.
    """
    spark = df.sparkSession
    pid = "_partition"
    rows = (df.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
            .withColumn(pid, F.spark_partition_id()))
    rows = cut(rows)
    totals = dict(rows.groupBy(pid).agg(F.sum(value).alias("total")).collect())
    offsets, running = {}, 0
    for p in sorted(totals):
        offsets[p] = running
        running += totals[p] or 0

    def add(batches):
        seen = None
        for b in batches:
            if b.num_rows == 0:
                continue
            t = pa.Table.from_batches([b])
            v = t.column(value).combine_chunks().fill_null(0).to_numpy(zero_copy_only=False)
            if seen is None:
                seen = offsets[t.column(pid)[0].as_py()]
            before = seen + np.concatenate([[0], np.cumsum(v)])
            seen = int(before[-1])
            yield from (t.drop_columns([pid]).append_column(out, pa.array(before[:-1], pa.int64()))
                        .combine_chunks().to_batches())

    schema = rows.drop(pid).withColumn(out, F.lit(0).cast("bigint")).schema
    return rows.mapInArrow(add, schema)

"""Connected components of a distributed edge table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.shared import cut, shuffle_width

#: Edges that a task joins up at a time before any shuffle.
CHUNK = 1 << 20


def _forests(batches):
    """Each chunk of edges as stars around the smallest node of its own components (``u > v``)."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    def stars():
        nodes = [x for x in up if root(x) != x]
        out = pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["u", "v"])
        up.clear()
        return out

    n = 0
    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                up[max(x, y)] = min(x, y)
        n += b.num_rows
        if n >= CHUNK:
            yield stars()
            n = 0
    if up:
        yield stars()


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Distinct ``(node, root)`` of every node of ``edges``; root = smallest node of its component.

    Tasks first join up the edges they hold, a bounded chunk at a time.  Then alternating star
    rounds: each node hands its larger neighbours, then its smaller ones, to its smallest
    neighbour, until every node hangs on its root; the number of rounds grows with the
    logarithm of the longest path.  Between tasks only grouped minima and joins are used, so a hub with very
    many links is never gathered in one place.  Rows with a null end or equal ends are ignored; an
    empty table gives an empty result.
    """
    width = shuffle_width(edges.sparkSession)

    def least(rows: DataFrame) -> DataFrame:
        # dealt out once more, so that the join after it shuffles both of its sides and a hub's rows can be split
        low = rows.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
        return low.repartition(width, F.xxhash64("x"))

    ends = edges.select(F.col(a).cast("bigint").alias("u"), F.col(b).cast("bigint").alias("v")).filter("u <> v")
    links = cut(ends.mapInArrow(_forests, "u bigint, v bigint").distinct())
    for _ in range(max_rounds):
        # done when no node has two smaller neighbours, and none that has one is itself a root
        seen = links.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")),
                                              F.struct(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))).alias("e"))
        state = seen.groupBy("e.node").agg(F.sum("e.below").alias("below"), F.max("e.above").alias("above"))
        if state.filter("below > 1 or below = 1 and above = 1").isEmpty():
            break
        # large star: every larger neighbour of x moves to the smallest neighbour of x (or x)
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = least(both).select("x", F.least("x", "m").alias("m"))
        large = both.join(low, F.col("u") == F.col("x")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large)
        # small star: the smaller neighbours of x, and x, move to the smallest of them
        small = (large.join(least(large), F.col("u") == F.col("x"))
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter("u != v").distinct())
        links = cut(small)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)

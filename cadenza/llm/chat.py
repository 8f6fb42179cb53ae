"""Reply trees to chat transcripts.

Messages are rows ``(tree_id, node_id, parent_id, role, text, score)``.  Pointer
doubling by self-joins (each round joins a table of jumps with itself, so a tree of
depth d takes log2 d rounds) gives every node's depth and the sum of scores on its
path from the root.  Leaves are the ends of root-to-leaf paths; a tree's branches are
ranked by summed score (ties: the deeper leaf, then the smaller node) and the best
``top`` are formatted.  The jumps, taken backwards, mark the nodes of a chosen path.

A transcript marks every turn as ``<turn role="..."`` + ``>`` text ``</turn>`` + line end.  In
roles and texts a backslash is written ``\\\\`` and ``<`` is written ``\\l`` (in roles also ``"``
as ``\\q``), so no control string can occur inside a text and the escape is exactly
reversible.  The loss mask is the code-point spans of the assistant's texts.

One conversation becomes one row, so its memory is its own length.  Null texts and
roles count as empty; a null tree_id is a tree of its own.  A parent that does not
exist makes its node a root.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.shared import cut

ASSISTANT = "assistant"
#: Characters of transcripts that a task gathers before it hands them on.
HELD_CHARS = 4 << 20
_ROLE = {"\\": "\\\\", "<": "\\l", '"': "\\q"}
_BACK = {"\\": "\\", "l": "<", "q": '"'}
_OPEN, _MID, _CLOSE = '<turn role="', '">', "</turn>\n"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l")


def escape_role(role: str) -> str:
    return "".join(_ROLE.get(c, c) for c in role)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text) if "\\" in text else text


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The transcript of ``(role, text)`` turns and the spans under its loss mask."""
    out, at, mask = [], 0, []
    for role, text in turns:
        head, body = _OPEN + escape_role(role) + _MID, escape(text)
        out += [head, body, _CLOSE]
        if role == ASSISTANT:
            mask.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(_CLOSE)
    return "".join(out), mask


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a transcript; the inverse of ``format_turns``."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(_OPEN, at):
            raise ValueError(f"no turn begins at {at}")
        mid = formatted.index(_MID, at + len(_OPEN))
        close = formatted.index(_CLOSE, mid + len(_MID))
        turns.append((unescape(formatted[at + len(_OPEN): mid]), unescape(formatted[mid + len(_MID): close])))
        at = close + len(_CLOSE)
    return turns


def chosen_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """``tree_id, branch, depth, role, text``: the messages on the ``top`` best root-to-leaf paths of each tree.

    ``branch`` ranks the paths from 1, ``depth`` counts from 0 at the root.  Of rows with equal tree and node_id
    the smallest (parent, role, text, score) stays; rows without a node_id are left out.  A node on a cycle of
    parents (its own parent included), or below one, has no root and is on no path.
    """
    fields = ["parent_id", "role", "text", "score"]
    m = messages.filter("node_id is not null").withColumn(
        "_tree", F.struct(F.col("tree_id").isNull().alias("none"), F.coalesce("tree_id", F.lit(0)).alias("id")))
    m = cut(m.groupBy("_tree", "node_id").agg(F.min(F.struct(*fields)).alias("_m"))
            .select("_tree", "node_id", F.when(~F.col("_tree.none"), F.col("_tree.id")).alias("tree_id"), *[f"_m.{c}" for c in fields]))
    # a path is no longer than its tree, so after that many doublings what is open is on or below a cycle
    largest = m.groupBy("_tree").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    real = m.select("_tree", F.col("node_id").alias("parent_id")).withColumn("_there", F.lit(True))
    links = m.select("_tree", "node_id", "parent_id", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    links = links.join(real, ["_tree", "parent_id"], "left")
    # a node's jump, and the number and score of the nodes from it up to, not including, the jump's end
    reach = cut(links.select("_tree", "node_id", F.when(F.col("_there"), F.col("parent_id")).alias("jump"),
                             F.lit(1).cast("bigint").alias("n"), F.col("score").alias("total")))
    jumps = [reach]
    for _ in range(largest.bit_length()):
        open_ = reach.filter("jump is not null")
        if open_.isEmpty():
            break
        far = reach.select("_tree", F.col("node_id").alias("jump"), F.col("jump").alias("_jump"), F.col("n").alias("_n"), F.col("total").alias("_total"))
        step = open_.join(far, ["_tree", "jump"]).select("_tree", "node_id", F.col("_jump").alias("jump"),
                                                         (F.col("n") + F.col("_n")).alias("n"), (F.col("total") + F.col("_total")).alias("total"))
        reach = cut(step.union(reach.filter("jump is null")))
        jumps.append(reach)
    reach = reach.filter("jump is null")
    parents = links.filter("_there").select("_tree", F.col("parent_id").alias("node_id")).distinct()
    leaves = reach.join(parents, ["_tree", "node_id"], "left_anti")
    best = Window.partitionBy("_tree").orderBy(F.col("total").desc(), F.col("n").desc(), "node_id")
    on = (leaves.withColumn("branch", F.row_number().over(best)).filter(F.col("branch") <= top)
          .select("_tree", "branch", "node_id"))
    # backwards through the jumps: every marked node also marks the end of its jump
    for level in reversed(jumps[:-1]):
        ends = (on.join(level.filter("jump is not null").select("_tree", "node_id", "jump"), ["_tree", "node_id"])
                .select("_tree", "branch", F.col("jump").alias("node_id")))
        on = cut(on.union(ends).distinct())
    depth = reach.select("_tree", "node_id", (F.col("n") - 1).alias("depth"))
    return (on.join(depth, ["_tree", "node_id"]).join(m, ["_tree", "node_id"])
            .select("tree_id", "branch", "depth", "role", "text"))


def transcripts(messages: DataFrame, top: int = 1) -> DataFrame:
    """``tree_id, branch, formatted, mask`` (spans of code points) of each chosen path."""
    turn = F.struct("depth", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = chosen_paths(messages, top).groupBy("tree_id", "branch").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def run(batches):
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            texts, masks, first, held = [], [], 0, 0

            def out(to):
                part = b.slice(first, to - first)
                return pa.RecordBatch.from_arrays([part.column("tree_id"), part.column("branch"), pa.array(texts, pa.string()), pa.array(masks, span)],
                                                  names=["tree_id", "branch", "formatted", "mask"])

            for i in range(b.num_rows):  # one conversation at a time, handed on by size
                turns = b.column("turns")[i].as_py()
                text, mask = format_turns([(t["role"], t["text"]) for t in turns])
                texts.append(text)
                masks.append([{"start": a, "end": z} for a, z in mask])
                held += len(text)
                if held > HELD_CHARS:
                    yield out(i + 1)
                    texts, masks, first, held = [], [], i + 1, 0
            if texts:
                yield out(b.num_rows)

    return rows.mapInArrow(run, "tree_id bigint, branch int, formatted string, mask array<struct<start:bigint,end:bigint>>")


def digests(formatted: DataFrame) -> DataFrame:
    """Read back from transcripts: ``n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    def run(batches):
        for b in batches:
            rows = []
            for i in range(b.num_rows):
                text = b.column("formatted")[i].as_py()
                mask = b.column("mask")[i].as_py()
                turns = parse_turns(text)
                all_turns, loss, n = hashlib.sha256(), hashlib.sha256(), 0
                for role, body in turns:
                    all_turns.update(f"{role}\n{body}\n".encode())
                for s in mask:
                    part = unescape(text[s["start"]: s["end"]])
                    n += len(part)
                    loss.update(part.encode())
                rows.append((len(turns), all_turns.hexdigest(), n, loss.hexdigest(), len(text)))
            got = pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            yield pa.RecordBatch.from_arrays([b.column("tree_id"), *[pa.array(got[c]) for c in got]], names=["tree_id", *got.columns])

    return formatted.select("tree_id", "formatted", "mask").mapInArrow(
        run, "tree_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")

"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A document is the multiset of its words.  For sample k, a word t of weight w (its
count) gets r and c from Gamma(2, 1) and b uniform, all functions of (k, t);
``u = floor(ln w / r + b)`` and ``ln a = ln c - r (u - b + 1)``, and the sample is the
(t, u) with the smallest a.  Two documents have the same k-th sample with a
probability equal to the generalised Jaccard similarity of their word counts, sum
of minima over sum of maxima.  A fingerprint is the ``SAMPLES`` samples, 32 bits each.

Rows are dealt out once by ranges of doc_id; word counts, minima and each row's
successor are then computed inside a range without another shuffle of texts.  Inside a range
a word's draws are made once, and what most words need (weight 1) is a look-up.

Null texts count as empty; a text without words has the fingerprint of zeros, and two
such are alike (1.0).  Rows of equal doc_id follow one another in the order of a hash
of their text; null ids come last.  An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.shared import shuffle_width

SAMPLES = 64
#: Samples drawn, and kept as minima, in one row.
TOGETHER = 16
#: Words ``[^\x20\x09-\x0D]+``.
SPACES = r"[\x20\x09-\x0D]+"
_21 = (1 << 21) - 1
_32 = (1 << 32) - 1
#: An odd factor that spreads u over the bits of an identity (u stays below 2^27).
_SPREAD = 0x9E3779B1


def _uniform(h: Column, part: int) -> Column:
    """One of three numbers of 21 bits of a hash, in (0, 1)."""
    return (F.shiftrightunsigned(h, 21 * part).bitwiseAND(F.lit(_21)) + F.lit(0.5)) / F.lit(float(1 << 21))


def draws(term: Column, k: Column) -> dict[str, Column]:
    """What sample k draws of a term, whatever its weight: identity ``h``, gamma ``r``, uniform ``b``, ``ln c``."""
    h = F.xxhash64(term, k)
    g = F.xxhash64(h, F.lit(-1) - k)
    return {"h": h, "r": -F.ln(_uniform(h, 0) * _uniform(h, 1)), "b": _uniform(h, 2), "ln_c": F.ln(-F.ln(_uniform(g, 0) * _uniform(g, 1)))}


def _packed(ln_a: Column, who: Column) -> Column:
    """``ln a`` (upper 32 bits, fixed point) and the identity of (t, u) (lower 32 bits) as one long."""
    return F.shiftleft((ln_a * F.lit(float(1 << 24))).cast("bigint"), 32).bitwiseOR(who.bitwiseAND(F.lit(_32)))


def sample(drawn: dict[str, Column], ln_weight: Column) -> Column:
    """The packed sample of a term of this weight."""
    u = F.floor(ln_weight / drawn["r"] + drawn["b"])
    return _packed(drawn["ln_c"] - drawn["r"] * (u - drawn["b"] + F.lit(1.0)), drawn["h"].bitwiseXOR(u * F.lit(_SPREAD)))


def once(drawn: dict[str, Column]) -> Column:
    """The packed sample of a term of weight 1 (``u`` is 0 then)."""
    return _packed(drawn["ln_c"] - drawn["r"] * (F.lit(1.0) - drawn["b"]), drawn["h"])


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints."""
    same = [F.when(F.substring(a, 8 * k + 1, 8) == F.substring(b, 8 * k + 1, 8), 1).otherwise(0) for k in range(samples)]
    return reduce(add, same) / F.lit(float(samples))


def fingerprints(terms: DataFrame, by: list[str], samples: int = SAMPLES, part: str | None = None) -> DataFrame:
    """``by`` and ``fingerprint`` of each group of ``terms`` (``by``, ``term`` a long), with repeats as weights.

    ``part``: a column of ``by`` that the rows are dealt out by.  A term's draws, which do not depend on its
    weight, are then made once for all documents of a part, where its rows already are.
    """
    weighted = terms.groupBy(*by, "term").agg(F.ln(F.count(F.lit(1)).cast("double")).alias("ln_w"))
    key = [part] if part else []
    kept = [c for c in by if c != part]
    lists = weighted.groupBy(*key, "term").agg(F.collect_list(F.struct(*kept, "ln_w")).alias("held"))
    # a few samples to a row: expressions over all of them would be too long for the JVM to compile
    step = min(TOGETHER, samples)
    lists = lists.withColumn("_from", F.explode(F.array(*[F.lit(k) for k in range(0, samples, step)])))
    every = [draws(F.col("term"), F.col("_from") + F.lit(j)) for j in range(step)]
    drawn = {n: F.array(*[d[n] for d in every]).alias(f"_{n}") for n in ("h", "r", "b", "ln_c")}
    names = [*key, "_from", *[f"_{n}" for n in drawn], "_once"]
    rows = lists.select(*key, "_from", *drawn.values(), F.array(*[once(d) for d in every]).alias("_once"), "held")
    rows = rows.select(*names, F.explode("held").alias("_e")).select(*names, "_e.*")

    def value(j: int) -> Column:
        return F.when(F.col("ln_w") == 0, F.get("_once", F.lit(j))).otherwise(
            sample({n: F.get(f"_{n}", F.lit(j)) for n in drawn}, F.col("ln_w")))

    least = rows.groupBy(*by, "_from").agg(*[F.min(value(j)).alias(f"s{j}") for j in range(step)])
    text = F.concat_ws("", *[F.when(F.col("_from") + F.lit(j) < samples, F.lpad(F.lower(F.hex(F.col(f"s{j}").bitwiseAND(F.lit(_32)))), 8, "0"))
                             for j in range(step)])
    parts = least.select(*by, F.struct("_from", text.alias("text")).alias("part"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda x: x["text"]), "")
    return parts.groupBy(*by).agg(whole.alias("fingerprint"))


def _dealt(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows by ranges (``bucket``) of descending doc_id, each range ending with a guest: its successor's first row."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    marks = [i / buckets for i in range(1, buckets)] or [0.5]
    bounds = docs.agg(F.percentile_approx("doc_id", marks, 10_000).alias("b")).first()["b"]  # one number per range
    if bounds:
        over = F.array(*[F.lit(b) for b in sorted(set(bounds))])
        bucket = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(
            F.size(F.filter(over, lambda b: F.col("doc_id") < b)))
    else:
        bucket = F.lit(0)
    keyed = docs.withColumn("bucket", bucket.cast("int"))
    heads = keyed.groupBy("bucket").agg(F.max("doc_id").alias("head"))  # a row per range
    order = Window.orderBy("bucket")
    every = Window.partitionBy(F.lit(1))
    heads = heads.select("head", F.col("bucket").alias("of"),
                         F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(every)).alias("into"))
    at = keyed.join(F.broadcast(heads), (F.col("bucket") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("head")), "left")

    def place(b, guest):
        return F.struct(F.col(b).alias("bucket"), F.lit(guest).alias("guest"))

    places = F.when(F.col("into").isNull(), F.array(place("bucket", False))).otherwise(F.array(place("bucket", False), place("into", True)))
    rows = at.select("doc_id", "text", F.xxhash64("text").alias("text_key"), F.explode(places).alias("place"))
    rows = rows.select("place.bucket", "place.guest", "doc_id", "text_key", "text")
    return rows.repartitionByRange(buckets, "bucket")


def with_neighbours(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of each row.

    The edited text is the text whose last half is replaced by as much of the next
    document's beginning, in descending doc_id (the first follows the last).
    """
    rows = _dealt(docs, shuffle_width(docs.sparkSession))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.col("text_key").desc())
    rows = rows.select("bucket", "guest", "doc_id", "text", F.row_number().over(order).alias("rn"), F.lead("text").over(order).alias("next"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - half), F.coalesce(F.col("next"), F.lit("")).substr(F.lit(1), half))
    rows = rows.select("bucket", "guest", "rn", "doc_id", "text", n.cast("bigint").alias("n_chars"), edited.alias("edited"))
    # a third entry of each row carries what is told of it, so that nothing has to be joined back
    told = F.struct("guest", "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    nothing = F.lit(None).cast("struct<guest:boolean,doc_id:bigint,n_chars:bigint,edited_sha256:string>")

    def entry(kind, text, info):
        return F.struct(F.lit(kind).alias("kind"), text.alias("t"), info.alias("info"))

    entries = F.array(entry(0, F.col("text"), nothing), entry(1, F.col("edited"), nothing), entry(2, F.lit(""), told))
    terms = (rows.select("bucket", "rn", F.explode(entries).alias("x"))
             .select("bucket", "rn", F.col("x.kind").alias("kind"), F.col("x.info").alias("info"), F.explode(F.split("x.t", SPACES)).alias("word"))
             .filter("word != '' or kind = 2").select("bucket", "rn", "kind", "info", F.xxhash64("word").alias("term")))
    prints = fingerprints(terms, ["bucket", "rn", "kind", "info"], samples, "bucket")
    none = F.lit("0" * 8 * samples)
    found = prints.groupBy("bucket", "rn").agg(
        F.coalesce(F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))), none).alias("fingerprint"),
        F.coalesce(F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))), none).alias("edited_fingerprint"), F.max("info").alias("info"))
    follow = Window.partitionBy("bucket").orderBy("rn")
    found = (found.withColumn("next_fingerprint", F.lead("fingerprint").over(follow))
             .select("info.*", "fingerprint", "edited_fingerprint", "next_fingerprint").filter("not guest"))
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
                        likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"))

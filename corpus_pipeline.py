"""The training-corpus pipeline: five stages from documents to packed token ids.

Each stage takes ``(spark, docs, sf_dir)``, applies one operator of ``cadenza.llm`` to
all of ``docs`` and returns what its decisions keep, with the columns of documents
(the last one returns id matrices).  ``run`` writes each stage's result as Parquet
under the shared checkpoint folder and reads it again for the next.

Every stage keeps rows with nulls in columns it does not judge, carries extra
columns along and gives an empty result for empty documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import decontaminate, language, mixing, packing
from cadenza.llm.jaccard_join import jaccard_components
from cadenza.llm.shared import landed, may_hold, table, text_key, written
from cadenza.session import ship_package

#: A document whose language explains less of it than this, measured by the language's own text, is rejected.
MIN_LANGUAGE_SCORE = 0.5


def _parted(docs: DataFrame) -> DataFrame:
    """``text`` and, as one struct ``rest``, all other columns, so that none of them meets a name a stage uses."""
    return docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest"))


def _whole(parted: DataFrame, columns: list[str]) -> DataFrame:
    return parted.select(*[F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language: not ``und``, and a score of ``MIN_LANGUAGE_SCORE`` or more of what the
    language's own training text scores (which is less where an alphabet is large).

    The filters are learned from the documents' own ``lang``, without the held-out fold.
    """
    ship_package(spark)
    model = language.fit(docs.filter(~language.held_out()))
    told = language.predict(_parted(docs), model, ["text", "rest"])
    least = F.lit(None).cast("double")
    for name, own in zip(model.languages, model.own, strict=True):
        least = F.when(F.col("lang_pred") == name, F.lit(MIN_LANGUAGE_SCORE * float(own))).otherwise(least)
    return _whole(told.filter((F.col("lang_pred") != language.UND) & (F.col("score") >= least)), docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id (of equal ids, the first text key).

    Documents without words belong to no group and stay.
    """
    ship_package(spark)
    found = landed(jaccard_components(docs).filter("n_shingles > 0").select("doc_id", "text_key", "root"), "dedup-found")
    named = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    rows = found.groupBy("root", named.alias("name")).agg((F.count(F.lit(1)) > 1).alias("repeated"))
    first = found.groupBy("root").agg(F.min(named).alias("first"))
    # rows that go, or are there more than once: all others stay as they are, and only texts that may be of these are shuffled
    doubtful = landed(rows.join(first, "root").withColumn("stays", F.col("name").eqNullSafe(F.col("first")))
                      .filter("repeated or not stays").select("name.*", "stays"), "dedup-doubtful")

    def keyed(rows, doc_id):  # a null id as two plain columns, so that one shuffle of the texts serves join and repeats
        return rows.withColumns({"none": doc_id.isNull(), "id": F.coalesce(doc_id, F.lit(0))})

    keys = ["none", "id", "key"]
    stays = keyed(doubtful.withColumnRenamed("text_key", "key"), F.col("doc_id")).select(*keys, "stays")
    parted = _parted(docs)
    has_words = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    texts = keyed(parted.withColumn("key", text_key(F.col("text"))), F.col("rest.doc_id"))
    may_be = may_hold(stays.select(F.xxhash64(*keys)))(F.xxhash64(*keys))
    checked = texts.filter(has_words).filter(may_be).join(stays, keys, "left").filter("stays is null or stays").dropDuplicates(keys)
    return _whole(texts.filter(~has_words | ~may_be), docs.columns).union(_whole(checked, docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark (fewer than a twentieth of their words are hit)."""
    ship_package(spark)
    found = decontaminate.contamination(_parted(docs), table(spark, sf_dir, "benchmark"), keep=["text", "rest"])
    found = found.withColumn("n_hit", decontaminate.hit_words())
    return _whole(found.filter(~decontaminate.contaminated()), docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: repeated by epoch, each source cut at its exact word budget."""
    ship_package(spark)
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed id matrices of all documents."""
    ship_package(spark)
    return packing.packed(docs)


STAGES = [
    ("language ID", language_stage),
    ("n-gram Jaccard join", dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("token-ID / binary output", packing_stage),
]

#: Token ids cannot be expressed in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{i + 1}")
    return docs

"""Registered queries of this folder: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm import chat, decontaminate, divergence, fingerprints, html_text, language, licenses, line_dedup, mixing, packing, periodic_runs, url_rules
from cadenza.llm.jaccard_join import jaccard_components
from cadenza.llm.shared import table


#: The rules that go before the mined ones.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL; a page is labelled by the document of its number (bad: low quality or toxic)."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    found = url_rules.judged(table(spark, sf_dir, "pages"), labels, URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, a tree whose rows each answer the one before, as one transcript, read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.union(extra).withColumn("node_id", F.row_number().over(order).cast("bigint"))
    messages = numbered.select(F.col("conv_id").alias("tree_id"), "node_id",
                               F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"),
                               "role", "text", F.lit(0.0).alias("score"))
    return chat.digests(chat.transcripts(messages)).withColumnRenamed("tree_id", "conv_id")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents (five words, similarity 0.75)."""
    found = jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op4_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed id matrices of 2,048 ids a row."""
    return packing.packed(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences found in every document."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "license", "dice", F.size("matches").cast("bigint").alias("n_matches"),
                        F.array_join(F.transform("matches", lambda m: F.concat_ws(
                            ":", m["license"], m["from_word"].cast("string"), m["to_word"].cast("string"))), ",").alias("matches"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: words, repeats counted."""
    got = mixing.taken(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "source_size", "target", "taken")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return fingerprints.with_neighbours(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; three of four folds are learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", language.held_out().alias("held_out"))
    model = language.fit(docs.filter("not held_out"))
    return language.predict(docs.select("doc_id", "held_out", "text"), model, ["doc_id", "held_out"])


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier document has; the code points that went, as ``start-end``."""
    found = line_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("removed").cast("bigint").alias("n_removed"),
                        F.array_join(F.transform("removed", lambda r: F.concat_ws(
                            "-", r["start"].cast("string"), r["end"].cast("string"))), ",").alias("removed"),
                        F.length("text").cast("bigint").alias("kept_chars"),
                        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside windows of 13 words of a test item, and the items."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    rows = found.select("doc_id", "n_words", decontaminate.hit_words().alias("n_hit"),
                        F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"))
    return rows.withColumn("contaminated", decontaminate.contaminated())


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and each source's terms above its language."""
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.extracted(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), "n_template")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document (each tenth made to repeat itself) and the text without the repeats."""
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), periodic_runs.planted, with_text=False)
    # the longest run; of equal lengths the smallest start, then period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    found = found.withColumns({"best": best, "listed": F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")})
    length, period = F.col("best.length"), -F.col("best.col3")
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.col2")).alias("start"), length.alias("length"),
                        period.alias("period"), F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"),
                        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"), "collapsed_sha256")


QUERIES = {
    "op1_url_rules": op1_url_rules,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_token_packing": op4_token_packing,
    "op5_license_scan": op5_license_scan,
    "op6_source_mix": op6_source_mix,
    "op7_fingerprints": op7_fingerprints,
    "op8_language_id": op8_language_id,
    "op9_line_dedup": op9_line_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_source_divergence": op11_source_divergence,
    "op12_html_text": op12_html_text,
    "op13_periodic_runs": op13_periodic_runs,
}

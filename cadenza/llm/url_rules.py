"""URL filters: fixed host and path rules, and association rules mined from labels.

A URL's tokens are its host labels and the words of its path and query.  FP-growth
over the labelled URLs (tokens and the label as items) gives rules "tokens -> bad";
those of enough support and confidence are kept, and of two rules where one's tokens
contain the other's, the smaller one if it is no less sure.  Rules are matched by an
inverted index: each is filed under its rarest token, a URL looks up its tokens and
checks the rest of the rule.

Fixed rules are ``(action, host, path)``: they fit the host and its subdomains if the
path starts with theirs, the longest wins, and they go before mined ones.

A null URL or one without ``://`` has an empty host and path, no tokens, and is
allowed.  Null labels count as unlabelled.  Empty tables give no rules or no rows.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.shared import cut, shuffle_width

#: Share of labelled URLs that a rule's tokens and the label must have in common.
MIN_SUPPORT = 0.0005
#: And the fewest such URLs, so that a small table does not make rules of chance.
MIN_COUNT = 20
MIN_CONFIDENCE = 0.6
BAD = "=bad"
#: Mined rules up to this many rows are broadcast; more are joined by a shuffle.
BROADCAST_RULES = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Sorted distinct tokens: host labels (``h:``), words of the path (``p:``) and of query and fragment (``q:``)."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*(.*)", 1), F.lit(""))

    def words(text, mark):
        return F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9]+)"), F.lit(1)), lambda w: F.concat(F.lit(mark), w))

    labels = F.transform(F.filter(F.split(host_of(url), r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("h:"), x))
    return F.array_sort(F.array_distinct(F.concat(labels, words(path_of(url), "p:"), words(rest, "q:"))))


def fixed_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as a struct (n, action, rule), or null."""
    fits = [F.when((host.eqNullSafe(F.lit(h)) | host.endswith(F.lit("." + h))) & path.startswith(F.lit(p)),
                   F.struct(F.lit(len(h + p)).alias("n"), F.lit(a).alias("action"), F.lit(h + p).alias("rule")))
            for a, h, p in rules]
    return F.array_max(F.array(*fits))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         min_count: int = MIN_COUNT) -> DataFrame:
    """Rules ``antecedent`` (sorted tokens), ``confidence``, ``support`` from rows ``(tokens, bad)``."""
    items = labelled.filter("bad is not null and size(tokens) > 0").select(
        F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens")).alias("items"))
    items = cut(items)
    n = items.count()
    if n < min_count:
        return items.select(F.col("items").alias("antecedent"), F.lit(0.0).alias("confidence"), F.lit(0.0).alias("support")).limit(0)
    model = FPGrowth(itemsCol="items", minSupport=max(min_support, min_count / n), minConfidence=min_confidence,
                     numPartitions=shuffle_width(labelled.sparkSession)).fit(items)
    rules = cut(model.associationRules.filter(F.col("consequent")[0] == BAD)
                .select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support"))
    # a rule goes if another one with fewer of its tokens is as sure: looked up by that rule's first token
    parts = rules.select("antecedent", "confidence", F.explode("antecedent").alias("token"))
    small = rules.select(F.col("antecedent").alias("small"), F.col("confidence").alias("sure"), F.col("antecedent")[0].alias("token"))
    worse = (parts.join(small, "token")
             .filter((F.size("small") < F.size("antecedent")) & (F.col("sure") >= F.col("confidence"))
                     & (F.size(F.array_except("small", "antecedent")) == 0)).select("antecedent").distinct())
    return rules.join(worse, "antecedent", "left_anti")


def matched(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``tokens`` of the rows of ``token_sets`` that some rule fits, with the surest rule's ``confidence`` and tokens."""
    sets = token_sets.select("tokens").distinct()
    posted = sets.select("tokens", F.explode("tokens").alias("token"))
    often = posted.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    filed = (rules.select("antecedent", "confidence", F.explode("antecedent").alias("token")).join(often, "token")
             .groupBy("antecedent").agg(F.min(F.struct("n", "token")).alias("rarest"), F.max("confidence").alias("confidence"))
             .select(F.col("rarest.token").alias("token"), "antecedent", "confidence"))
    filed = cut(filed)
    filed = F.broadcast(filed) if filed.count() <= BROADCAST_RULES else filed
    return (posted.join(filed, "token").filter(F.size(F.array_except("antecedent", "tokens")) == 0)
            .groupBy("tokens").agg(F.max(F.struct("confidence", "antecedent")).alias("why")))


def judged(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]],
           min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_count: int = MIN_COUNT) -> DataFrame:
    """``page_id, host, path, rule, verdict, confidence, antecedent`` of each page.

    ``labels`` (``page_id``, ``bad`` true or false) teaches the mined rules.
    """
    pages = pages.select("page_id", "url").withColumns({
        "host": host_of(F.col("url")), "path": path_of(F.col("url")), "tokens": tokens_of(F.col("url"))})
    known = labels.filter("bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    mined = mine(pages.select("page_id", "tokens").join(known, "page_id"), min_support, min_confidence, min_count)
    hit = matched(pages, mined).withColumnRenamed("tokens", "_tokens")
    rows = pages.join(hit, F.col("tokens") == F.col("_tokens"), "left")
    rows = rows.withColumn("fixed", fixed_rule(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("fixed.action"), F.when(F.col("why").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return rows.select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), verdict.alias("verdict"),
                       F.col("why.confidence").alias("confidence"), F.col("why.antecedent").alias("antecedent"))

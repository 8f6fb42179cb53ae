"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query pins the session time zone to UTC (epoch <-> text conversions
depend on it) before building its plan.

Each query reads the driver tables (or frames Spark derives from them) and
exercises one group of operators from the inventory; the matching DuckDB SQL
lives in ``cadenza.plans.oracles``.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.fixed import FEATURE_COLUMNS, GENRE_LABELS, TOP_IN_CLUSTER
from cadenza.functions.prefs import request_values
from cadenza.functions.similarity import similarity_ratio as ratio_udf
from cadenza.functions.text import html_unescape, is_media_link, matched_term, permalink
from cadenza.functions.titles import clean_titles
from cadenza.operators import feeds as FD
from cadenza.operators import fuzzy as FZ
from cadenza.operators import label_store as LS
from cadenza.operators import matching as MT
from cadenza.operators import quantile_state as QS
from cadenza.operators import recommend as RC
from cadenza.operators import report_state as RS
from cadenza.operators import tuning as TU
from cadenza.operators.cleaning import drop_columns, drop_incomplete
from cadenza.operators.enrich import attach_features, track_artists
from cadenza.operators.labels import with_major_genre
from cadenza.operators.reports import (combine_partials, genre_partials, genre_report_sql,
                                       report_from_partials)
from cadenza.operators.vectors import nearest, squared_distance
from cadenza.plans import standins as S
from cadenza.session import scratch_path
from cadenza.sources import handover as HO
from cadenza.sources import checked as CK
from cadenza.sources import lake as LK
from cadenza.sources import state as ST
from cadenza.sources import warehouse as WH

def q_genre_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake rows are lineitem plays of part tracks.  Plays are reduced to partial sums per
    track before the join (map-side), so the join and the re-grouping by genre list see one
    row per track instead of one per play."""
    per_track = genre_partials(S.play_features(spark, sf_dir), "l_partkey")
    p = S.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), S.genre_list(F.col("p_name"), F.col("p_size")).alias("genres"))
    per_list = combine_partials(per_track.join(p, "l_partkey"), "genres")
    return report_from_partials(per_list, S.RUN_DATE)


def q_label_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = S.table(spark, sf_dir, "part").select(
        "p_partkey", S.genre_list(F.col("p_name"), F.col("p_size")).alias("genres"))
    return with_major_genre(p, "genres", "major_genre")


def q_similarity_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ratio(label, name) on every distinct (vocabulary label, part name) pair."""
    names = S.table(spark, sf_dir, "part").select(F.col("p_name").alias("b")).distinct()
    pairs = names.select(F.explode(F.array(*[F.lit(x) for x in GENRE_LABELS])).alias("a"), "b")
    return pairs.select("a", "b", ratio_udf("a", "b").alias("ratio"))


def q_title_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = S.part_titles(spark, sf_dir)
    return clean_titles(t, "title").select(
        "p_partkey", "title", "truncated", "part0", "part1", "search_text")


def q_html_unescape(spark: SparkSession, sf_dir: str) -> DataFrame:
    pg = S.table(spark, sf_dir, "pages")
    return pg.select("page_id", html_unescape(F.col("html")).alias("text"))


def q_link_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 on every page url: the predicate and the first matching host term."""
    pg = S.table(spark, sf_dir, "pages")
    return pg.select("page_id", "url", is_media_link(F.col("url")).alias("is_media_link"),
                     matched_term(F.col("url")).alias("link_term"))


def _rules(spark):
    return FD.rules_table(spark, S.FEED_SOURCES)


def q_feed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = FD.attach_rules(S.feed_posts(spark, sf_dir), _rules(spark))
    return (FD.apply_flair_rules(posts)
            .select("post_id", "feed", "flair",
                    permalink(F.col("permalink_prefix"), F.col("post_id")).alias("post_url")))


def _marks(spark, sf_dir):
    latest = ST.latest_marks(S.history_rows(spark, sf_dir))
    return ST.marks_with_default(_rules(spark), latest, S.RUN_DATE)


def _newer_posts(spark, sf_dir):
    posts = S.feed_posts(spark, sf_dir).join(F.broadcast(_marks(spark, sf_dir)), "source")
    return FD.take_while(posts, ["source"], S.post_order(),
                         F.col("created") > F.col("last_time"))


def q_feed_takewhile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _newer_posts(spark, sf_dir).select("source", "post_id", "created_utc")


def q_watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = FD.apply_flair_rules(FD.attach_rules(_newer_posts(spark, sf_dir), _rules(spark)))
    return FD.advance_watermark(accepted, _marks(spark, sf_dir), S.post_order())


def q_run_state_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.latest_marks(S.history_rows(spark, sf_dir))


def _clean_posts(spark, sf_dir):
    return clean_titles(S.part_posts(spark, sf_dir), "title").withColumn("block", F.col("part1"))


def q_title_dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys' repeat numbers (the dots are rendered by ``dedup_keys``, at the edge)."""
    return MT.repeat_numbers(_clean_posts(spark, sf_dir)).select(
        "post_id", "title", "ord", "is_repeat", F.coalesce("repeat_no", F.lit(0)).alias("repeat_no"))


def q_entity_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = MT.match_posts(_clean_posts(spark, sf_dir), S.part_catalogue(spark, sf_dir))
    return m.select("post_id", "title", "track_id", "track_name", "artists_name", "cand_rank",
                    "track_score", "artist_score")


def q_fuzzy_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue names within 0.3 edits a character of every misspelt name of the block."""
    pairs = FZ.fuzzy_pairs(S.misspelt_names(spark, sf_dir), S.part_catalogue(spark, sf_dir), "block", "asked", "track_name")
    return pairs.select("block", F.col("left_key").alias("asked"), F.col("right_key").alias("track_name"), "distance")


def q_artist_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    ta, artists = S.order_artists(spark, sf_dir)
    return track_artists(ta, artists, "track_id")


def q_enrich_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = S.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.col("c_nationkey").alias("nationkey"))
    s = S.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey"), "s_suppkey", "s_acctbal")
    return attach_features(c, s, "nationkey", F.col("s_suppkey"), "left").select(
        "c_custkey", "c_name", "s_suppkey", "s_acctbal")


def q_enrich_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inner variant of the enrichment join: documents that have labels; others go."""
    d = S.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    found = S.table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return attach_features(d, found, "doc_id", F.struct("quality", "toxic"), "inner").select(
        "doc_id", "lang", "source", "quality", "toxic")


FEED_PAGE = 100


def q_feed_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pull of the feed API: the newest 100 posts of each feed."""
    return FD.newest_first(S.feed_posts(spark, sf_dir), ["source"], FEED_PAGE).select("source", "post_id", "created_utc")


SUPPLIER_DECLARED = "s_suppkey BIGINT, s_name STRING, s_nationkey STRING, s_acctbal DOUBLE"


def hard_title():
    """A text with outer spaces, quotes, a comma and a line end."""
    return F.concat(F.lit(" "), F.col("s_name"), F.lit(' - "B, C"\n\\ x '))


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier through a CSV hand-over folder, read back onto a declared schema
    (the int nation key declared as string, like the lake's ``mode``)."""
    from cadenza.functions.dates import hour_stamp
    path = f"{scratch_path(spark, 'handover')}/{hour_stamp(S.RUN_DATE + ' 12:00:00')}"
    HO.write_csv(S.table(spark, sf_dir, "supplier").withColumn("s_title", hard_title()), path)
    return HO.read_csv(spark, path, SUPPLIER_DECLARED + ", s_title STRING")


LAKE_DAY = "1996-01-01"


def q_lake_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders into a year/month/day lake (ingest day = first of the order month),
    then one day read back with partition pruning."""
    o = S.table(spark, sf_dir, "orders")
    rows = o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate").withColumns(
        LK.date_partitions(F.date_trunc("month", "o_orderdate")))
    path = scratch_path(spark, "lake")
    LK.write_lake(rows, path)
    return LK.read_lake_day(spark, path, LAKE_DAY, drop_partitions=False)


def q_lake_many_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lake's days of one half-year, named by a table of dates, in one pruned read."""
    o = S.table(spark, sf_dir, "orders")
    rows = o.select("o_orderkey", "o_custkey", "o_orderdate").withColumns(LK.date_partitions(F.date_trunc("month", "o_orderdate")))
    path = scratch_path(spark, "lake")
    LK.write_lake(rows, path)
    dates = o.select(F.date_trunc("month", "o_orderdate").alias("date")).where("date >= '1996-01-01' AND date < '1996-07-01'")
    return LK.read_lake_days(spark, path, dates).select("o_orderkey", "o_custkey", "o_orderdate", "year", "month", "day")


def q_report_sql_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as a SQL client reads it: a view over the lake view and the label function."""
    from cadenza.sources.sql_clients import publish
    publish(spark, LK.with_run_date(S.lake_rows(spark, sf_dir), S.RUN_DATE))
    return spark.sql("SELECT * FROM genre_report_by_day")


def q_quartiles_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles merged from stored sketches of each day (ship month) and cluster: how many values each covers, and
    whether each answer's true rank lies within the stated error."""
    rows = S.lineitem_features(spark, sf_dir)
    path = scratch_path(spark, "sketches")
    QS.store_sketches(rows.withColumn("day", F.date_format("l_shipdate", "yyyy-MM")), path, "l_returnflag", FEATURE_COLUMNS)
    merged = QS.merged_quartiles(spark, path, FEATURE_COLUMNS)
    asked = merged.select("cluster", "feature", "n", F.posexplode("values").alias("i", "answer"))
    long = rows.select(F.col("l_returnflag").alias("cluster"), F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).alias("v")) for f in FEATURE_COLUMNS])).alias("x")).select("cluster", "x.*")
    # five answers per cluster and feature meet the counted values
    counted = long.groupBy("cluster", "feature", "v").agg(F.count(F.lit(1)).alias("k"))
    ranks = (asked.join(counted, ["cluster", "feature"]).groupBy("cluster", "feature", "n", "i", "answer")
             .agg(F.sum(F.when(F.col("v") < F.col("answer"), F.col("k")).otherwise(0)).alias("below"),
                  F.sum(F.when(F.col("v") <= F.col("answer"), F.col("k")).otherwise(0)).alias("upto")))
    q, e = F.col("i") / 4, QS.rank_error()
    within = (F.col("below") / F.col("n") <= q + e) & (F.col("upto") / F.col("n") >= q - e)
    return ranks.select(F.col("cluster").alias("l_returnflag"), "feature", F.col("i").alias("quartile"), "n", within.alias("within_error"))


def q_k_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sweep's curves, the bend of each k and the k chosen."""
    return TU.choose_k(q_k_sweep(spark, sf_dir))


def q_report_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report written with SQL over a temp view, stored in a partitioned catalog table
    (dynamic overwrite: re-running the day replaces it) and read back."""
    rep = genre_report_sql(spark, S.lake_rows(spark, sf_dir), S.RUN_DATE)
    WH.write_report_table(rep, "daily_genre_report", scratch_path(spark, "warehouse"))
    return WH.read_report_table(spark, "daily_genre_report")


def q_na_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with injected nulls (error type) and NaN (value < 1): drop columns, drop rows."""
    e = S.table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "props",
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        F.when(F.col("value") < 1, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    return drop_incomplete(drop_columns(e, ["user_id", "props"]))


def _release(result: DataFrame, cached: DataFrame) -> DataFrame:
    """Materialise a small result in the shared checkpoint folder (reliable
    checkpoint), then drop the cached training layout it was computed from."""
    from cadenza.session import checkpoint_dir
    checkpoint_dir(result.sparkSession)
    out = result.checkpoint(eager=True)
    cached.unpersist()
    return out


def q_scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = S.lineitem_features(spark, sf_dir)
    assembled = RC.assembler().transform(f)
    scaled = RC.scaler().fit(assembled).transform(assembled)
    return scaled.select("l_orderkey", "l_linenumber",
                         *[c.alias(n) for n, c in RC.scaled_columns(digits=6).items()])


def _label_centres(e: DataFrame) -> tuple[list[int], list[list[float]]]:
    """Per-label mean embedding; k rows of a model parameter, small by construction."""
    n = len(e.select("vec").first()[0])
    rows = (e.groupBy("label").agg(F.array(*[F.avg(F.col("vec")[i]) for i in range(n)]).alias("m"))
            .orderBy("label").collect())
    return [r["label"] for r in rows], [list(r["m"]) for r in rows]


def q_cluster_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding to the nearest of fixed centres (the per-label means)."""
    e = S.embedding_rows(spark, sf_dir)
    ids, centres = _label_centres(e)
    idx, dist = nearest(F.col("vec"), centres)
    return e.select("vec_id", "label",
                    F.element_at(F.array(*[F.lit(i) for i in ids]), idx + 1).alias("cluster"),
                    F.round(dist, 6).alias("distance"))


def q_kmeans_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-means (k=5, seed=3) on the embeddings; cluster sizes."""
    e = RC.stable_layout(S.embedding_rows(spark, sf_dir).select("vec_id", "standardized"),
                         "vec_id")
    model = RC.kmeans().fit(e)
    sizes = model.transform(e).groupBy(F.col("prediction").alias("cluster")).agg(
        F.count(F.lit(1)).alias("size"))
    return _release(sizes, e)


def q_kmeans_fit_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the k-means fit, whatever its centres: every row is assigned to its
    nearest centre, no cluster is empty, and the cost of the assignment is not above the
    cost of the last training pass."""
    e = RC.stable_layout(S.embedding_rows(spark, sf_dir).select("vec_id", "standardized"), "vec_id")
    model = RC.kmeans().fit(e)
    centres = [[float(v) for v in c] for c in model.clusterCenters()]
    rows = model.transform(e).withColumn("vec", vector_to_array("standardized"))
    _, best = nearest(F.col("vec"), centres)
    mine = F.element_at(F.array(*[F.array(*[F.lit(v) for v in c]) for c in centres]), F.col("prediction") + 1)
    own = squared_distance(F.col("vec"), mine)
    trained = model.summary.trainingCost
    checks = rows.select("prediction", own.alias("own"), best.alias("best")).agg(
        F.lit(len(centres)).alias("k"), F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("prediction").alias("clusters_used"),
        F.count_if(F.col("own") <= F.col("best") * (1 + 1e-9) + 1e-12).alias("rows_at_nearest"),
        (F.sum("own") <= F.lit(trained * (1 + 1e-9))).alias("cost_not_above_training"))
    return _release(checks, e)


def q_silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.embedding_rows(spark, sf_dir).withColumn("prediction", F.col("label").cast("double"))
    return spark.createDataFrame([(round(TU.silhouette(e), 9),)], "silhouette double")


def q_elbow_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.embedding_rows(spark, sf_dir)
    return TU.clustering_cost(e, "vec", "label").select(F.round("cost", 4).alias("cost"))


def q_k_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = RC.stable_layout(S.embedding_rows(spark, sf_dir).select("vec_id", "standardized"),
                         "vec_id")
    out = TU.k_sweep(e)  # rows already collected per k
    e.unpersist()
    return out


def q_k_sweep_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sweep's curves against the data's total sum of squares (the cost of one cluster)."""
    rows = S.embedding_rows(spark, sf_dir)
    total = F.lit(TU.clustering_cost(rows.withColumn("whole", F.lit(0)), "vec", "whole").first()["cost"])  # one number
    return q_k_sweep(spark, sf_dir).select(
        "k", F.round(total, 4).alias("total_cost"),
        F.col("silhouette").between(-1, 1).alias("silhouette_in_range"),
        ((F.col("cost") > 0) & (F.col("cost") < total)).alias("cost_below_total"))


def q_cluster_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = TU.cluster_quartiles(S.lineitem_features(spark, sf_dir), "l_returnflag", FEATURE_COLUMNS)
    return q.select(*[F.round(c, 9).alias(c) if c != "l_returnflag" else F.col(c)
                      for c in q.columns])


def _requests(spark, sf_dir):
    r = S.preference_requests(spark, sf_dir)
    labels = {d: F.col(f"{d}_label") for d in FEATURE_COLUMNS}
    return r.withColumns(request_values(labels, mode="midpoint"))


def q_preference_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference labels to seeded uniform draws, repeatable per request."""
    r = S.preference_requests(spark, sf_dir)
    drawn = request_values({d: F.col(f"{d}_label") for d in FEATURE_COLUMNS}, mode="uniform", seed=1, key=F.col("request_id"))
    return r.select("request_id", *[F.round(c, 9).alias(d) for d, c in drawn.items()])


def q_preference_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requests(spark, sf_dir)


def q_recommend_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch scoring with fixed centres (per-type means of the scaled track features)."""
    tracks = RC.assembler().transform(
        with_major_genre(S.part_tracks(spark, sf_dir), "genres", "major_genre"))
    sc = RC.scaler().fit(tracks)
    st = sc.transform(tracks).withColumn("vec", vector_to_array("standardized"))
    n = len(FEATURE_COLUMNS)
    rows = (st.groupBy("p_type").agg(F.array(*[F.avg(F.col("vec")[i]) for i in range(n)])
                                     .alias("m")).orderBy("p_type").collect())
    centres = [list(r["m"]) for r in rows]
    tidx, _ = nearest(F.col("vec"), centres)
    track_clusters = st.withColumn("prediction", tidx)
    req = RC.assembler().transform(RC.complete_requests(_requests(spark, sf_dir)))
    rs = sc.transform(req).withColumn("vec", vector_to_array("standardized"))
    ridx, _ = nearest(F.col("vec"), centres)
    request_clusters = rs.select("request_id", ridx.alias("prediction"))
    return RC.response_rows(RC.recommend(request_clusters, track_clusters.select(*RC.RESPONSE_COLUMNS, "prediction")))


def _trained_and_scored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tracks and requests with the cluster that the fitted pipeline gives them, and the cached training layout."""
    lake = S.lake_rows(spark, sf_dir)
    p = S.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("track_id"), F.col("p_name").alias("track_name"),
        F.col("p_brand").alias("artists_name"),
        (F.lit(2000) + F.col("p_size")).cast("string").alias("release_date"),
        (F.col("p_retailprice") * 100).cast("int").alias("duration_ms"))
    train = RC.prepare_training(lake).join(p, "track_id")
    model, data = RC.fit_on_layout(train, "track_id")
    reqs = RC.assign(model, RC.complete_requests(_requests(spark, sf_dir))).select("request_id", "prediction")
    return RC.assign(model, data), reqs, data


def q_recommend_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The engine end to end: train the pipeline on lake rows, score every request."""
    tracks, reqs, data = _trained_and_scored(spark, sf_dir)
    return _release(RC.response_rows(RC.recommend(reqs, tracks.select(*RC.RESPONSE_COLUMNS, "prediction"))), data)


def q_recommend_kmeans_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of each request's answer, whatever the centres: five picks in order of
    popularity, each a track of the request's cluster and as popular as its tenth at least."""
    tracks, reqs, data = _trained_and_scored(spark, sf_dir)
    picks = RC.recommend(reqs, tracks.select("track_id", "track_popularity", "prediction")).select(
        "request_id", "prediction", "track_id", "track_popularity", "position")
    own = tracks.select("track_id", "prediction", F.lit(True).alias("own")).distinct()
    # popularity of the tenth row of each cluster, from counts of the few popularity values
    counts = tracks.groupBy("prediction", "track_popularity").agg(F.count(F.lit(1)).alias("n"))
    above = F.sum("n").over(W.partitionBy("prediction").orderBy(F.col("track_popularity").desc()))
    tenth = (counts.withColumn("upto", above).where(F.col("upto") >= TOP_IN_CLUSTER)
             .groupBy("prediction").agg(F.max("track_popularity").alias("tenth")))
    before = F.lag("track_popularity").over(W.partitionBy("request_id").orderBy("position"))
    checked = picks.withColumn("before", before).join(own, ["track_id", "prediction"], "left").join(tenth, "prediction", "left")
    out = reqs.select("request_id").join(checked, "request_id", "left").groupBy("request_id").agg(
        F.count("track_id").alias("picks"), F.count("own").alias("of_own_cluster"),
        F.count_if(F.col("track_popularity") >= F.coalesce("tenth", F.lit(-1))).alias("in_top"),
        F.coalesce(F.bool_and(F.coalesce(F.col("before") >= F.col("track_popularity"), F.lit(True))), F.lit(False)).alias("in_order"))
    return _release(out, data)


def q_stream_feed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed pages landed as JSON, loaded by the streaming job (availableNow), read back."""
    from cadenza.streaming.feed_load import run_feed_load
    landing = scratch_path(spark, "landing")
    S.land_feed_pages(spark, sf_dir, landing)
    sink, ckpt = scratch_path(spark, "posts"), scratch_path(spark, "stream-ckpt")
    run_feed_load(spark, landing, _marks(spark, sf_dir), sink, ckpt)
    return spark.read.parquet(sink).select("source", "post_id", "created_utc")


def q_stream_takewhile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in no order of time, loaded three files at a time by the stream's take-while, read back."""
    from cadenza.streaming.feed_load import run_stream, stream_while
    landing = scratch_path(spark, "landing")
    S.land_feed_pages(spark, sf_dir, landing, newest_first=False)
    sink, ckpt = scratch_path(spark, "posts"), scratch_path(spark, "stream-ckpt")
    run_stream(stream_while(spark, landing, _marks(spark, sf_dir), 3).select("source", "post_id", "created_utc"), sink, ckpt)
    return spark.read.parquet(sink)


def q_landed_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed event line: typed and good, or bad with its reason; undeclared fields by name."""
    told = CK.check_json(S.event_lines(spark, sf_dir).withColumnRenamed("event_id", "line"), T.StructType.fromDDL(S.EVENT_FIELDS)).told
    good = F.size("reasons") == 0
    return told.select("line", F.when(good, "good").otherwise("bad").alias("status"), F.when(~good, F.array_join("reasons", "; ")).alias("reason"),
                       F.col("row.event_type").alias("event_type"), F.col("row.value").alias("amount"),
                       F.when(good, F.array_join(F.map_keys("unknown"), ",")).alias("unknown"))


def q_handover_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of a damaged hand-over file: typed and good, or bad with its reason."""
    path = scratch_path(spark, "handover")
    S.land_supplier_csv(spark, sf_dir, path)
    good, bad = CK.check_csv(spark, path, T.StructType.fromDDL(S.SUPPLIER_FIELDS))
    key = F.regexp_extract("raw", "([0-9]+)", 1).cast("int")
    return (good.select("s_suppkey", F.lit("good").alias("status"), F.lit(None).cast("string").alias("reason"), "s_acctbal")
            .union(bad.select(key, F.lit("bad"), F.array_join("reasons", "; "), F.lit(None).cast("double"))))


def q_label_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels from a stored token dictionary that an earlier run, over the smaller parts, began."""
    p = S.table(spark, sf_dir, "part").select("p_partkey", "p_size", S.genre_list(F.col("p_name"), F.col("p_size")).alias("genres"))
    path = scratch_path(spark, "label-dictionary")
    LS.learn_tokens(p.where("p_size < 5"), path)
    rows, _ = LS.label_incremental(p, path)
    return rows.select("p_partkey", "genres", "major_genre")


def q_report_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of three days from stored partial sums: a first batch, late rows for the same days, the late batch again."""
    plays = S.dated_plays(spark, sf_dir)
    path = scratch_path(spark, "report-state")
    for batch in ("first", "late", "late"):
        RS.absorb(plays.where(F.col("brought_by") == batch), path, batch)
    return RS.report(spark, path)


def q_stream_accepted_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed rules applied inside the stream (flair, link, title cleaning), read back."""
    from cadenza.streaming.feed_load import run_stream, stream_accepted_posts
    landing = scratch_path(spark, "landing")
    S.land_feed_pages(spark, sf_dir, landing)
    sink, ckpt = scratch_path(spark, "accepted"), scratch_path(spark, "stream-ckpt")
    run_stream(stream_accepted_posts(spark, landing, _rules(spark), _marks(spark, sf_dir)), sink, ckpt)
    return spark.read.parquet(sink).select("source", "post_id", "created_utc", "post_title", "part0",
                                           "part1", "searching_context", "post_url")


def q_stream_extract_to_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract job as a stream (foreachBatch) over the same landed JSON, read back."""
    import datetime as _dt
    from cadenza.streaming.feed_load import run_extract_stream
    root = scratch_path(spark, "extract-stream")
    S.land_extract_inputs(spark, sf_dir, f"{root}/landing")
    run_ts = _dt.datetime.fromisoformat(S.RUN_DATE) + _dt.timedelta(hours=12)
    run_extract_stream(spark, f"{root}/landing", FD.rules_table(spark), f"{root}/state",
                       f"{root}/lake", f"{root}/ckpt", run_ts)
    return LK.read_lake_day(spark, f"{root}/lake", S.RUN_DATE, drop_partitions=False)


def q_extract_to_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract job on landed JSON made from part: one run into an empty lake and
    state table, then the run's lake partition read back (pruned)."""
    import datetime as _dt
    from cadenza.operators.ingest import run_extract
    root = scratch_path(spark, "extract")
    S.land_extract_inputs(spark, sf_dir, f"{root}/landing")
    run_ts = _dt.datetime.fromisoformat(S.RUN_DATE) + _dt.timedelta(hours=12)
    run_extract(spark, f"{root}/landing", FD.rules_table(spark), f"{root}/state", f"{root}/lake", run_ts)
    return LK.read_lake_day(spark, f"{root}/lake", S.RUN_DATE, drop_partitions=False)


def q_lake_read_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders into the year/month/day lake, then the whole lake read back (S8):
    partition values come back as integers."""
    o = S.table(spark, sf_dir, "orders")
    rows = o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate").withColumns(
        LK.date_partitions(F.date_trunc("month", "o_orderdate")))
    path = scratch_path(spark, "lake")
    LK.write_lake(rows, path)
    return LK.read_lake(spark, path)


QUERIES = {
    "fuzzy_candidates": q_fuzzy_candidates,
    "lake_many_days": q_lake_many_days,
    "report_sql_client": q_report_sql_client,
    "quartiles_from_sketches": q_quartiles_from_sketches,
    "k_choice": q_k_choice,
    "landed_quarantine": q_landed_quarantine,
    "handover_quarantine": q_handover_quarantine,
    "label_dictionary": q_label_dictionary,
    "report_incremental": q_report_incremental,
    "stream_takewhile": q_stream_takewhile,
    "genre_report": q_genre_report,
    "label_classify": q_label_classify,
    "similarity_ratio": q_similarity_ratio,
    "title_clean": q_title_clean,
    "html_unescape": q_html_unescape,
    "link_filter": q_link_filter,
    "feed_rules": q_feed_rules,
    "feed_takewhile": q_feed_takewhile,
    "watermark_advance": q_watermark_advance,
    "run_state_latest": q_run_state_latest,
    "title_dedup_keys": q_title_dedup_keys,
    "entity_match": q_entity_match,
    "artist_genres": q_artist_genres,
    "enrich_dedupe": q_enrich_dedupe,
    "enrich_inner": q_enrich_inner,
    "feed_newest": q_feed_newest,
    "csv_roundtrip": q_csv_roundtrip,
    "lake_partition_roundtrip": q_lake_partition_roundtrip,
    "lake_read_all": q_lake_read_all,
    "report_table": q_report_table,
    "na_drop": q_na_drop,
    "scaled_features": q_scaled_features,
    "cluster_assign": q_cluster_assign,
    "kmeans_fit": q_kmeans_fit,
    "kmeans_fit_checks": q_kmeans_fit_checks,
    "silhouette": q_silhouette,
    "elbow_cost": q_elbow_cost,
    "k_sweep": q_k_sweep,
    "k_sweep_checks": q_k_sweep_checks,
    "cluster_quartiles": q_cluster_quartiles,
    "preference_buckets": q_preference_buckets,
    "preference_uniform": q_preference_uniform,
    "recommend_topn": q_recommend_topn,
    "recommend_kmeans": q_recommend_kmeans,
    "recommend_kmeans_checks": q_recommend_kmeans_checks,
    "stream_feed_load": q_stream_feed_load,
    "stream_accepted_posts": q_stream_accepted_posts,
    "extract_to_lake": q_extract_to_lake,
    "stream_extract_to_lake": q_stream_extract_to_lake,
}


def _utc(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES = {name: _utc(fn) for name, fn in QUERIES.items()}

"""What the n-gram join and the stage that uses it leave on disk and send through shuffles."""

import os

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from cadenza.llm import jaccard_join as J
from cadenza.llm.shared import landed, may_hold


def _shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def test_shuffle_files_go_with_their_query(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = _shuffle_files(spark)
    made = landed(spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count(), "freed")
    assert made.count() == 7 and spark.conf.get(key, None) is None
    names = {f.split("_")[1] for f in _shuffle_files(spark) - before}
    assert len(names) <= 1  # none of the written query; one of the count above


def test_buckets_grow_with_the_texts(spark):
    def texts(n):  # of 1 MB each
        return spark.range(n).select(F.expr("repeat('some text ', 100000)").alias("text"))

    assert J.bucket_bits(texts(0)) == J.LEAST_BUCKET_BITS
    assert J.bucket_bits(texts(1000)) == 21 and J.bucket_bits(texts(2000)) == 22


def test_bucket_ranks_follow_the_counts(spark):
    common, rare = "a b c d e", "f g h i j"
    docs = spark.createDataFrame([(common,)] * 300 + [(rare,), (None,), ("",)], "text string").repartition(5)
    ranks = J.bucket_ranks(docs, 5)
    (_, x), (_, y) = J.shingles_of(J.pa.array([common, rare]), 5)
    got = [int(ranks[int(v[0] >> np.uint64(64 - J.LEAST_BUCKET_BITS))]) for v in (x, y)]
    assert got == [round(11 * np.log2(301)), 11] and np.count_nonzero(ranks) == 2


def _described(spark, rows):
    point = J.packed_point(np.ones(64, np.int32))
    return spark.createDataFrame([(c, n, bytearray(point), [s << J.BAND_BITS | int(J.band_of(np.array([n]))[0]) for s in shared])
                                  for c, n, shared in rows], "class long, n_shingles long, point binary, prefix array<long>")


def test_sets_that_share_few_prefix_shingles_do_not_meet(spark):
    assert J.least_shared() == 3 and J.least_shared(1, 2) == 1 and J.least_shared(60, 100) == 2
    described = _described(spark, [(1, 40, [5]), (2, 40, [5, 6]), (3, 40, [5, 6, 7, 8]), (4, 41, [6, 7, 8])])
    got = {(r["a"], r["b"]) for r in J._ties(described, J.SMALL_BLOCK, J.NUM, J.DEN).collect()}
    assert got == {(3, 4)}


def test_large_blocks_tie_only_sizes_that_can_link(spark):
    sizes = [10, 12, 13, 900, 1000, 1100]
    described = _described(spark, [(c, n, [5]) for c, n in enumerate(sizes)])
    got = J._ties(described, 2, J.NUM, J.DEN).collect()
    side = [{r["a"] // 3, r["b"] // 3} for r in got]
    assert len(got) == 4 and all(len(x) == 1 for x in side)


def test_bands_of_linked_sizes_are_neighbours():
    for num, den in ((75, 100), (1, 2), (9, 10)):
        a = np.arange(1, 5000)
        assert (J.band_of(a * den // num, num, den) - J.band_of(a, num, den)).max() <= 1


def test_points_keep_their_counts_whatever_their_width():
    for n in (1, 300, 70_000):
        for most in (1, 255, 256, 65_535, 65_536):
            point = np.arange(J.groups_for(n), dtype=np.int32) % 3
            point[-1] = most
            assert (J.unpacked_point(J.packed_point(point), n) == point).all()


def test_may_hold_loses_no_key_and_passes_few_others(spark):
    rows = spark.range(20_000).select("id", F.xxhash64("id").alias("key"))
    holds = may_hold(rows.filter("id % 10 = 0").select("key"))
    got = [r["id"] for r in rows.filter(holds(F.col("key"))).select("id").collect()]
    assert set(range(0, 20_000, 10)) <= set(got) and len(got) < 2_000 + 0.03 * 18_000
    none = may_hold(rows.limit(0).select("key"))
    assert rows.filter(none(F.col("key"))).count() == 0


def test_dedup_stage_shuffles_only_texts_in_doubt(spark):
    def text(name):
        return " ".join(f"{name}{i}" for i in range(30))

    # 300 texts that stay, two near copies, one row there twice, one row without words
    rows = [(i, text(f"w{i}x")) for i in range(300)] + [(900, text("w5x") + " tail"), (901, text("w6x") + " tail"), (7, text("w7x")), (902, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = corpus_pipeline.dedup_stage(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(300), 902]
    # both branches, the texts that stay and those that are looked up, meet the filter
    plan = kept._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ArrowEvalPython") == 2

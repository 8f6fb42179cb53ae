"""The scheduled jobs end to end on the smallest tables: extract -> report -> train -> score."""

import datetime as dt

from pyspark.sql import functions as F

from cadenza import jobs
from cadenza.plans import standins as S

SF = "/root/testdata/sf0.001"


def test_jobs_end_to_end(spark, tmp_path):
    root = str(tmp_path)
    S.land_extract_inputs(spark, SF, f"{root}/landing")
    jobs.extract_job(spark, f"{root}/landing", f"{root}/lake", f"{root}/state",
                     dt.datetime(2024, 1, 15, 12))
    rep = jobs.report_job(spark, f"{root}/lake", "jobs_report", "2024-01-15", f"{root}/wh")
    assert rep.agg(F.sum("NumberOfSongs")).first()[0] == spark.read.parquet(f"{root}/lake").count()
    # re-running the report replaces the day instead of appending it
    rep2 = jobs.report_job(spark, f"{root}/lake", "jobs_report", "2024-01-15", f"{root}/wh")
    assert rep2.count() == rep.count()
    jobs.train_job(spark, f"{root}/lake", f"{root}/model", f"{root}/tracks")
    reqs = S.preference_requests(spark, SF).limit(20)
    out = jobs.score_job(spark, f"{root}/model", f"{root}/tracks", reqs)
    per = {r["request_id"]: r["n"] for r in out.groupBy("request_id").agg(F.count("*").alias("n")).collect()}
    assert per and all(1 <= n <= 5 for n in per.values())
    positions = out.where(F.col("position") == 1).count()
    assert positions == len(per)


def test_tune_job(spark, tmp_path):
    root = str(tmp_path)
    S.land_extract_inputs(spark, SF, f"{root}/landing")
    jobs.extract_job(spark, f"{root}/landing", f"{root}/lake", f"{root}/state",
                     dt.datetime(2024, 1, 15, 12))
    sweep, quart = jobs.tune_job(spark, f"{root}/lake", [2, 3])
    assert sorted(r["k"] for r in sweep.collect()) == [2, 3]
    assert quart.count() >= 1 and "danceability_median" in quart.columns


def test_jobs_cli_report(spark, tmp_path):
    root = str(tmp_path)
    S.land_extract_inputs(spark, SF, f"{root}/landing")
    jobs.main(["extract", "--landing", f"{root}/landing", "--lake", f"{root}/lake",
               "--state", f"{root}/state", "--run-ts", "2024-01-15T12:00:00"])
    jobs.main(["report", "--lake", f"{root}/lake", "--table", "cli_report", "--run-date", "2024-01-15"])
    assert spark.table("cli_report").count() > 0


def test_report_table_survives_a_forgotten_catalog(spark, tmp_path):
    """Data stays at the table location when the catalog forgets the table (new session
    with an in-memory catalog): the next write re-registers it and replaces the day."""
    from cadenza.sources.warehouse import write_report_table
    df = spark.createDataFrame([("pop", 3, "2024", "01", "15")],
                               "Genre string, NumberOfSongs bigint, year string, month string, day string")
    path = str(tmp_path / "t")
    write_report_table(df, "forget_me", path)
    spark.catalog.dropTempView("forget_me")
    spark.sql("DROP TABLE forget_me")  # external: the files stay
    write_report_table(df.withColumn("NumberOfSongs", F.lit(4).cast("bigint")), "forget_me", path)
    rows = spark.table("forget_me").collect()
    assert [(r["Genre"], r["NumberOfSongs"]) for r in rows] == [("pop", 4)]


def test_ingest_csv_handover_roundtrip(spark, tmp_path):
    """Lake rows -> hour-stamped CSV hand-over -> ingest into a new lake: same rows, same types;
    a second ingest adds nothing."""
    from cadenza.sources.handover import write_csv
    from cadenza.sources import lake as LK
    root = str(tmp_path)
    S.land_extract_inputs(spark, SF, f"{root}/landing")
    run = dt.datetime(2024, 1, 15, 12)
    jobs.extract_job(spark, f"{root}/landing", f"{root}/lake", f"{root}/state", run)
    src = LK.read_lake_day(spark, f"{root}/lake", "2024-01-15")
    write_csv(src, f"{root}/handover/2024011512")
    out = jobs.ingest_job(spark, f"{root}/handover", f"{root}/lake2", run)
    assert out.schema == src.schema
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, src.collect()))
    assert jobs.ingest_job(spark, f"{root}/handover", f"{root}/lake2", run).count() == src.count()


def test_ingest_without_hour_folder_and_random_scoring(spark, tmp_path):
    """ingest_job falls back to the hand-over folder itself; score_job takes preference
    labels and draws uniform values with a seed (same seed, same picks)."""
    from cadenza.sources.handover import write_csv
    from cadenza.sources import lake as LK
    root = str(tmp_path)
    S.land_extract_inputs(spark, SF, f"{root}/landing")
    run = dt.datetime(2024, 1, 15, 12)
    jobs.extract_job(spark, f"{root}/landing", f"{root}/lake", f"{root}/state", run)
    src = LK.read_lake_day(spark, f"{root}/lake", "2024-01-15")
    write_csv(src, f"{root}/flat")
    assert jobs.ingest_job(spark, f"{root}/flat", f"{root}/lake2", run).count() == src.count()
    jobs.train_job(spark, f"{root}/lake", f"{root}/model", f"{root}/tracks")
    reqs = S.preference_requests(spark, SF)
    a = jobs.score_job(spark, f"{root}/model", f"{root}/tracks", reqs, order="random", seed=11)
    b = jobs.score_job(spark, f"{root}/model", f"{root}/tracks", reqs, order="random", seed=11)
    ra = sorted(tuple(r) for r in a.select("request_id", "track_id", "position").collect())
    assert ra and ra == sorted(tuple(r) for r in b.select("request_id", "track_id", "position").collect())
    per = a.groupBy("request_id").count().agg(F.max("count")).first()[0]
    assert 1 <= per <= 5


def test_bad_requests_get_the_defaults(spark, tmp_path):
    """Missing, NaN, textual and unknown preferences become the scoring defaults; the rest of the batch is unharmed,
    and the short list saved at training gives what the whole track table gives."""
    from cadenza.fixed import DEFAULT_REQUEST
    from cadenza.operators.recommend import complete_requests
    got = {r["request_id"]: r for r in complete_requests(spark.createDataFrame(
        [(1, "0.1", float("nan"), None, 0.3), (2, "word", 0.2, 0.4, 0.9)],
        "request_id int, danceability string, energy double, instrumentalness double, valence double")).collect()}
    assert (got[1]["danceability"], got[1]["energy"], got[1]["loudness"], got[1]["instrumentalness"]) == (0.1, 0.5, -10.1, 0.5)
    assert (got[2]["danceability"], got[2]["energy"], got[2]["valence"]) == (DEFAULT_REQUEST["danceability"], 0.2, 0.9)
    root = str(tmp_path)
    S.land_extract_inputs(spark, SF, f"{root}/landing")
    jobs.extract_job(spark, f"{root}/landing", f"{root}/lake", f"{root}/state", dt.datetime(2024, 1, 15, 12))
    jobs.train_job(spark, f"{root}/lake", f"{root}/model", f"{root}/tracks")
    labels = {f"{d}_label": "no such label" for d in DEFAULT_REQUEST}
    reqs = spark.createDataFrame([(1, *labels.values()), (2, *["", *list(labels.values())[1:]])], ["request_id", *labels])
    plain = spark.createDataFrame([(1, *DEFAULT_REQUEST.values())], ["request_id", *DEFAULT_REQUEST])
    bad = [tuple(r)[1:] for r in jobs.score_job(spark, f"{root}/model", f"{root}/tracks", reqs).where("request_id = 1").orderBy("position").collect()]
    good = [tuple(r)[1:] for r in jobs.score_job(spark, f"{root}/model", f"{root}/tracks", plain).orderBy("position").collect()]
    assert bad and bad == good
    top = spark.read.parquet(jobs.short_list_path(f"{root}/tracks"))
    assert top.groupBy("prediction").count().where("count > 10").isEmpty() and top.count() < spark.read.parquet(f"{root}/tracks").count()

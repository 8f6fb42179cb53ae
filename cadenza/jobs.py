"""Scheduled jobs: the programs a user runs, built from the operators.

    python -m cadenza.jobs extract --landing L --lake P --state S [--run-ts T]
    python -m cadenza.jobs ingest  --handover H --lake P [--run-ts T]
    python -m cadenza.jobs report  --lake P --table daily_genre_report [--run-date D]
    python -m cadenza.jobs train   --lake P --model M --tracks T
    python -m cadenza.jobs score   --model M --tracks T --requests R.json --out O
    python -m cadenza.jobs tune    --lake P --out O

Paths are shared storage (the lake, model and track table must be visible to
every executor).
"""

from __future__ import annotations

import argparse
import datetime as _dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.fixed import FEATURE_COLUMNS, K_SWEEP
from cadenza.functions.prefs import request_values
from cadenza.operators import recommend as RC
from cadenza.operators import tuning as TU
from cadenza.operators.feeds import rules_table
from cadenza.operators.ingest import run_extract
from cadenza.operators.reports import daily_genre_report
from cadenza.sources import lake as LK
from cadenza.sources import warehouse as WH
from cadenza.sources.missing import or_none

TRACK_COLUMNS = ["track_id", "track_name", "artists_name", "release_date", "track_popularity",
                 "duration_ms", "major_genre"]


def extract_job(spark: SparkSession, landing: str, lake: str, state: str,
                run_ts: _dt.datetime | None = None) -> DataFrame:
    """Landed JSON -> lake partition of the run date; state committed after the data."""
    return run_extract(spark, landing, rules_table(spark), state, lake,
                       run_ts or _dt.datetime.now().replace(microsecond=0))


def ingest_job(spark: SparkSession, handover: str, lake: str,
               run_ts: _dt.datetime | None = None, rejected: str | None = None) -> DataFrame:
    """Hand-over CSV (header, declared 24-column schema) -> lake partition of the run date.

    Reads ``handover/<YYYYMMDDHH>`` of the run hour when that folder exists,
    else the folder itself; rows already in the day's partition are skipped, so
    a re-run adds nothing twice.  Rows that do not fit the schema go, with their reasons, to
    ``rejected`` (default: ``<lake>-rejected``), a table partitioned by run date.
    """
    from cadenza.functions.dates import hour_stamp
    from cadenza.sources.checked import check_csv, quarantine
    run_ts = run_ts or _dt.datetime.now().replace(microsecond=0)
    run_date = run_ts.date().isoformat()
    src = f"{handover.rstrip('/')}/{hour_stamp(run_ts.isoformat())}"
    found = or_none(lambda: check_csv(spark, src, LK.LAKE_SCHEMA))
    if found is None:  # no hourly folder: read the folder itself
        found = check_csv(spark, handover, LK.LAKE_SCHEMA)
    rows = found.good
    quarantine(found.bad, rejected or f"{lake.rstrip('/')}-rejected", run_date)
    have = or_none(lambda: LK.read_lake_day(spark, lake, run_date))
    if have is not None:
        rows = rows.join(have.select("post_id").distinct(), "post_id", "left_anti")
    LK.write_lake(LK.with_run_date(rows, run_date), lake)
    return LK.read_lake_day(spark, lake, run_date)


def report_job(spark: SparkSession, lake: str, table: str, run_date: str | None = None,
               path: str | None = None, mode: str = "overwrite") -> DataFrame:
    """One lake day -> the partitioned report table (re-running the day replaces it)."""
    run_date = run_date or _dt.date.today().isoformat()
    rep = daily_genre_report(LK.read_lake_day(spark, lake, run_date), run_date)
    WH.write_report_table(rep, table, path, mode)
    return WH.read_report_table(spark, table)


def train_job(spark: SparkSession, lake: str, model_path: str, tracks_path: str,
              dedupe_tracks: bool = False) -> PipelineModel:
    """Fit assembler + scaler + k-means on the whole lake; save the model, the
    scored track table, partitioned by cluster, and beside it (``<tracks_path>-top``) each
    cluster's short list, which is all that the scoring job reads."""
    train = RC.prepare_training(LK.read_lake(spark, lake), dedupe_tracks)
    model, data = RC.fit_on_layout(train, "track_id")
    try:
        model.write().overwrite().save(model_path)
        scored = RC.assign(model, data).select(*TRACK_COLUMNS, "prediction")
        scored.write.mode("overwrite").partitionBy("prediction").parquet(tracks_path)
        top = RC.short_list(spark.read.parquet(tracks_path))
        top.coalesce(1).write.mode("overwrite").parquet(short_list_path(tracks_path))  # k x 10 rows
    finally:
        data.unpersist()
    return model


def short_list_path(tracks_path: str) -> str:
    return f"{tracks_path.rstrip('/')}-top"


def score_job(spark: SparkSession, model_path: str, tracks_path: str,
              requests: DataFrame, order: str = "hash", seed: int = 0) -> DataFrame:
    """Requests (request_id + five numbers, or five '<dim>_label' columns) -> up to
    five recommendations each.  What a request lacks, or a label nobody knows, is the scoring default."""
    if all(f"{d}_label" in requests.columns for d in FEATURE_COLUMNS):
        requests = requests.withColumns(request_values(
            {d: F.col(f"{d}_label") for d in FEATURE_COLUMNS},
            mode="uniform" if order == "random" else "midpoint", seed=seed, key=F.col("request_id")))
    model = PipelineModel.load(model_path)
    clusters = RC.assign(model, RC.complete_requests(requests)).select("request_id", "prediction")
    top = or_none(lambda: spark.read.parquet(short_list_path(tracks_path)))
    if top is not None:
        return RC.response_rows(RC.recommend(clusters, top, order=order, seed=seed, ranked=True))
    return RC.response_rows(RC.recommend(clusters, spark.read.parquet(tracks_path), order=order, seed=seed))


def tune_job(spark: SparkSession, lake: str, ks: list[int] = K_SWEEP) -> tuple[DataFrame, DataFrame]:
    """k sweep (silhouette + cost per k) and per-cluster five-number summaries at k=5."""
    train = RC.prepare_training(LK.read_lake(spark, lake))
    data = RC.stable_layout(train, "track_id")
    assembled = RC.assembler().transform(data)
    std = RC.scaler().fit(assembled).transform(assembled)
    sweep = TU.k_sweep(std, ks)
    predicted = RC.kmeans().fit(std).transform(std)
    quartiles = TU.cluster_quartiles(predicted, "prediction", FEATURE_COLUMNS)  # reads a checkpoint from here on
    data.unpersist()
    return sweep, quartiles


def main(argv: list[str] | None = None) -> None:
    from cadenza.session import get_session
    ap = argparse.ArgumentParser(prog="cadenza.jobs")
    ap.add_argument("job", choices=["extract", "ingest", "report", "train", "score", "tune"])
    for a in ("landing", "handover", "lake", "state", "table", "model", "tracks", "requests", "out",
              "run-ts", "run-date"):
        ap.add_argument(f"--{a}")
    args = ap.parse_args(argv)
    from cadenza.session import ship_package
    spark = get_session(app=f"cadenza-{args.job}")
    ship_package(spark)
    if args.job == "extract":
        ts = _dt.datetime.fromisoformat(args.run_ts) if args.run_ts else None
        extract_job(spark, args.landing, args.lake, args.state, ts).show()
    elif args.job == "ingest":
        ts = _dt.datetime.fromisoformat(args.run_ts) if args.run_ts else None
        print(ingest_job(spark, args.handover, args.lake, ts).count())
    elif args.job == "report":
        report_job(spark, args.lake, args.table or "daily_genre_report", args.run_date).show()
    elif args.job == "train":
        train_job(spark, args.lake, args.model, args.tracks)
    elif args.job == "score":
        score_job(spark, args.model, args.tracks, spark.read.json(args.requests)) \
            .write.mode("overwrite").parquet(args.out)
    elif args.job == "tune":
        sweep, quart = tune_job(spark, args.lake)
        sweep.write.mode("overwrite").parquet(f"{args.out}/k_sweep")
        quart.write.mode("overwrite").parquet(f"{args.out}/quartiles")


if __name__ == "__main__":
    main()

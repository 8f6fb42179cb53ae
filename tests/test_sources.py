"""Landed JSON readers, CSV hand-over, lake partitions, state table."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from cadenza.sources import landed as L
from cadenza.sources import lake as LK
from cadenza.sources import state as ST


def _write(path, name, obj):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(json.dumps(obj) + "\n")


def test_feed_pages(spark, tmp_path):
    page = {"data": {"children": [
        {"data": {"id": "p2", "title": "A &amp; B - C", "url": "https://youtu.be/x",
                  "created_utc": 1704196800.9, "link_flair_text": None}},
        {"data": {"id": "p1", "title": "D - E", "url": "https://x.org", "created_utc": 1704110400.0}}]}}
    _write(str(tmp_path / "source=Music"), "page1.json", page)
    _write(str(tmp_path / "source=popheads"), "page1.json", {"data": {"children": []}})
    posts = L.read_feed_pages(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r["source"], r["pos"], r["post_id"]) for r in posts] == [("Music", 0, "p2"), ("Music", 1, "p1")]
    assert posts[0]["created_utc"] == "2024-01-02 12:00:00"
    assert posts[0]["flair"] is None and posts[1]["flair"] is None


def test_search_artists_features(spark, tmp_path):
    _write(str(tmp_path / "search"), "s.json", {"post_id": "p", "tracks": {"items": [
        {"id": "t1", "name": "Song", "popularity": 50, "album": {"release_date": "2020"},
         "artists": [{"id": "a1", "name": "X"}, {"id": "a2", "name": "Y, Z"}]},
        {"id": "t2", "name": "Other", "popularity": 10, "album": {"release_date": "2019-05-01"},
         "artists": []}]}})
    _write(str(tmp_path / "artists"), "a.json", {"artists": [{"id": "a1", "genres": ["indie rock", "pop"]},
                                                          {"id": "a2", "genres": []}]})
    _write(str(tmp_path / "features"), "f.json", {"track_id": "t1", "audio_features": [
        {"danceability": 0.5, "energy": 0.7, "key": 5, "loudness": -6.1, "mode": 1, "speechiness": 0.04,
         "acousticness": 0.1, "instrumentalness": 0.0, "liveness": 0.1, "valence": 0.3, "tempo": 120.0,
         "duration_ms": 200000, "time_signature": 4}, None]})
    s = L.search_candidates(spark.read.schema(L.SEARCH_SCHEMA).json(str(tmp_path / "search")), k=10)
    rows = s.orderBy("cand_rank").collect()
    assert [(r["cand_rank"], r["track_id"], r["release_date"]) for r in rows] == [(1, "t1", "2020"), (2, "t2", "2019-05-01")]
    a = L.artist_genres(spark.read.schema(L.ARTISTS_SCHEMA).json(str(tmp_path / "artists")))
    assert {r["artist_id"]: r["genres"] for r in a.collect()} == {"a1": ["indie rock", "pop"], "a2": []}
    f = L.audio_features(spark.read.schema(L.AUDIO_SCHEMA).json(str(tmp_path / "features")))
    out = f.collect()
    assert len(out) == 1 and out[0]["duration_ms"] == 200000 and out[0]["mode"] == 1


def test_lake_partitions_prune(spark, tmp_path):
    df = spark.createDataFrame([("t1", 1.0), ("t2", 2.0)], "track_id string, energy double")
    path = str(tmp_path / "lake")
    LK.write_lake(LK.with_run_date(df, "2024-07-05"), path)
    LK.write_lake(LK.with_run_date(df, "2024-07-06"), path)
    assert os.path.isdir(os.path.join(path, "year=2024", "month=07", "day=05"))
    day = LK.read_lake_day(spark, path, "2024-07-05")
    assert sorted(r["track_id"] for r in day.collect()) == ["t1", "t2"]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "isnotnull(year" in plan


def test_state_roundtrip(spark, tmp_path):
    path = str(tmp_path / "state")
    assert ST.read_state(spark, path).count() == 0
    rules = spark.createDataFrame([("Music",), ("popheads",)], "source string")
    marks = ST.marks_with_default(rules, ST.latest_marks(ST.read_state(spark, path)), "2024-01-15")
    assert {r["source"]: r["last_time"] for r in marks.collect()} == {
        "Music": dt.datetime(2024, 1, 15), "popheads": dt.datetime(2024, 1, 15)}
    new = marks.withColumn("new_time", F.col("last_time") + F.expr("INTERVAL 1 HOUR"))
    ST.commit_state(new, path, dt.datetime(2024, 1, 15, 12))
    latest = ST.latest_marks(ST.read_state(spark, path))
    assert {r["source"]: r["last_time"] for r in latest.collect()} == {
        "Music": dt.datetime(2024, 1, 15, 1), "popheads": dt.datetime(2024, 1, 15, 1)}
    assert ST.latest_row(ST.read_state(spark, path)).count() == 1


def test_csv_keeps_hard_texts(spark, tmp_path):
    import pandas as pd

    from cadenza.sources.handover import read_csv, write_csv

    rows = [(1, ' lead trail '), (2, 'A - "B, C" x'), (3, 'two\nlines, "q"'), (4, 'back\\slash "'), (5, None)]
    df = spark.createDataFrame(rows, "id int, title string")
    write_csv(df, str(tmp_path / "own"))
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "own"), "id int, title string").collect())) == rows
    pd.DataFrame(rows, columns=["id", "title"]).to_csv(tmp_path / "pandas.csv", index=False)
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "pandas.csv"), "id int, title string").collect())) == rows


def test_a_failed_state_read_is_an_error(spark, tmp_path):
    import pytest

    from cadenza.sources.state import read_state

    assert read_state(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_bytes(b"no parquet at all")
    with pytest.raises(Exception):
        read_state(spark, str(tmp_path / "bad")).count()

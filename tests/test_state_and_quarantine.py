"""Nothing lost in silence, label dictionary, incremental report, take-while inside a stream, orders of frames."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.operators import label_store as LS
from cadenza.operators import report_state as RS
from cadenza.operators.labels import with_major_genre
from cadenza.operators.reports import daily_genre_report
from cadenza.sources import checked as CK

LAKE = "day string, genres string, track_popularity int, danceability double, energy double, valence double, loudness double"


def key(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_json_quarantine(spark):
    schema = T.StructType.fromDDL("id string, n int, f double, data struct<a:int,b:array<struct<c:bigint>>>")
    lines = {
        1: '{"id": "a", "n": 1, "f": 2, "data": {"a": 1, "b": [{"c": 5}, {}]}}', 2: '{"id": "a", "n": "word"}', 3: '{"id": "b"', 4: "[1]",
        5: '{"id": "c", "n": null, "x": {"y": 1}, "z": 2}', 6: None, 7: "", 8: '{"n": 2.5, "data": {"a": "q"}}', 9: '{"data": {"b": [{"c": 1}, {"c": "w"}]}}',
        10: '{"data": [1]}', 11: "{}", 12: '{"data": {"b": {"c": 1}}}'}
    got = CK.check_json(spark.createDataFrame(list(lines.items()), "k int, value string"), schema)
    good = {r["k"]: r for r in got.good.select("k", "id", "n", "f", "data", F.map_keys("unknown").alias("u"),
                                               F.to_json(F.col("unknown")["x"]).alias("x")).collect()}
    assert set(good) == {1, 5, 11}
    assert good[1]["n"] == 1 and good[1]["data"]["b"][0]["c"] == 5 and good[1]["u"] is None
    assert sorted(good[5]["u"]) == ["x", "z"] and good[5]["x"] == '{"y":1}' and good[5]["n"] is None
    bad = {r["k"]: r["reasons"] for r in got.bad.collect()}
    assert set(bad) == set(lines) - set(good)
    assert bad[2] == ['n: not int: "word"'] and bad[8] == ["n: not int: 2.5", 'data.a: not int: "q"']
    assert bad[9] == ['data.b[].c: not bigint: "w"'] and bad[3] == bad[4] == bad[6] == bad[7] == ["row: not a JSON object"]
    assert len(bad[10]) == len(bad[12]) == 1
    assert CK.check_json(spark.createDataFrame([], "k int, value string"), schema).good.count() == 0


def test_csv_quarantine(spark, tmp_path):
    schema = T.StructType.fromDDL("id string, n int, f double")
    (tmp_path / "a.csv").write_text('id,n,f\na,1,2.5\nb,x,1\nc,1\nd,1,2,3\n"e ""q""\nz",3,\n,,\n f ,7,nan\n')
    good, bad = CK.check_csv(spark, str(tmp_path / "a.csv"), schema)
    assert [r["id"] for r in good.orderBy("n").collect()] == [None, "a", 'e "q"\nz', " f "]
    assert sorted((r["raw"][:3], r["reasons"][0]) for r in bad.collect()) == [
        ("c,1", "row: not 3 fields"), ("d,1", "row: not 3 fields"), ('{"i', "n: not int: x")]
    at = str(tmp_path / "quarantine")
    for _ in range(2):  # a re-run of the date replaces its own rows
        CK.quarantine(bad, at, "2024-01-15")
    CK.quarantine(bad.limit(1), at, "2024-01-16")
    assert {(str(r["run_date"]), r["count"]) for r in spark.read.parquet(at).groupBy("run_date").count().collect()} == {("2024-01-15", 3), ("2024-01-16", 1)}


def test_ingest_quarantines_rejected_rows(spark, tmp_path):
    import datetime as dt

    from cadenza.jobs import ingest_job
    from cadenza.sources import lake as LK
    names = [f.name for f in LK.LAKE_SCHEMA.fields]
    row = ["5" if isinstance(f.dataType, (T.IntegerType, T.FloatType)) else f.name for f in LK.LAKE_SCHEMA.fields]
    wrong = [*row]
    wrong[names.index("track_popularity")] = "many"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join(",".join(x) for x in (names, row, ["p2", *wrong[1:]], ["p3", *row[1:-1]])) + "\n")
    lake = str(tmp_path / "lake")
    for _ in range(2):
        stored = ingest_job(spark, str(tmp_path / "in"), lake, dt.datetime(2024, 1, 15, 7))
        assert [r["track_popularity"] for r in stored.collect()] == [5]
    bad = spark.read.parquet(lake + "-rejected")
    assert sorted(r["reasons"][0][:16] for r in bad.collect()) == ["row: not 24 fiel", "track_popularity"]


def test_label_dictionary_scores_each_token_once(spark, tmp_path):
    lists = ["indie rock, dream pop", "k-pop, pop, pop", "", None, "deep house", "deep house, indie rock", "x,y, z"]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(lists)], "id int, genres string")
    path = str(tmp_path / "tokens")
    first, n = LS.label_incremental(df.where("id < 3"), path)
    assert n == 5 and first.count() == 3
    rows, n = LS.label_incremental(df, path)
    assert n == 3 and LS.label_incremental(df.repartition(5), path)[1] == 0
    assert key(rows.select("id", "major_genre").collect()) == key(with_major_genre(df).select("id", "major_genre").collect())
    # another vocabulary has a dictionary of its own
    other, n = LS.label_incremental(df, path, labels=["pop", "rock"])
    assert n == 8 and {r["major_genre"] for r in other.collect()} <= {"pop", "rock", None}
    stored = LS.read_dictionary(spark, path)
    assert stored.count() == stored.select("token").distinct().count() == 8


def test_incremental_report_equals_recompute(spark, tmp_path):
    day1 = [("2024-01-14", g, p, 0.25, None, 0.5, -1.0) for g, p in (("pop", 1), ("indie rock", 4), (None, 2), ("pop", None))]
    late = [("2024-01-14", "pop", 9, 0.3, 0.2, None, -2.0), ("2024-01-15", "techno, house", 3, 0.4, 0.2, 0.1, None)]
    path = str(tmp_path / "state")

    def df(rows):
        return spark.createDataFrame(rows, LAKE)

    def full(rows):
        return key(r for d in ("2024-01-14", "2024-01-15") for r in daily_genre_report(df(rows).where(F.col("day") == d), d).collect())

    assert [r["day"] for r in RS.absorb(df(day1), path, "b1").collect()] == ["2024-01-14"]
    assert key(RS.report(spark, path).collect()) == full(day1)
    assert {r["day"] for r in RS.absorb(df(late), path, "b2").collect()} == {"2024-01-14", "2024-01-15"}
    assert key(RS.report(spark, path).collect()) == full(day1 + late)
    RS.absorb(df(late), path, "b2")  # the same batch again
    assert key(RS.report(spark, path).collect()) == full(day1 + late)
    RS.absorb(df(late[:1]), path, "b2")  # run again with fewer rows: a day it no longer has is empty
    assert key(RS.report(spark, path).collect()) == full(day1 + late[:1])
    assert key(RS.report(spark, path, ["2024-01-15"]).collect()) == []
    plan = RS.report(spark, path, ["2024-01-14"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day" in plan or "PartitionFilters: [cast(day" in plan or "PartitionFilters: [" in plan


@pytest.mark.parametrize("max_files", [1, 2, None])
@pytest.mark.parametrize("newest_first", [True, False])
def test_stream_while_equals_batch(spark, tmp_path, max_files, newest_first):
    from cadenza.operators.feeds import take_while
    from cadenza.plans import queries as Q
    from cadenza.plans import standins as S
    from cadenza.sources.landed import read_feed_pages
    from cadenza.streaming.feed_load import run_stream, stream_while
    sf = "/root/testdata/sf0.001"
    landing, sink = str(tmp_path / "in"), str(tmp_path / "out")
    S.land_feed_pages(spark, sf, landing, newest_first)
    marks = Q._marks(spark, sf)
    run_stream(stream_while(spark, landing, marks, max_files), sink, str(tmp_path / "ckpt"))
    posts = read_feed_pages(spark, landing).join(marks, "source")
    want = take_while(posts, ["source", "page"], F.col("pos"), F.col("created") > F.col("last_time"), broadcast_stops=False)
    assert key(spark.read.parquet(sink).select("source", "post_id").collect()) == key(want.select("source", "post_id").collect())


def test_stop_inside_a_page(spark):
    from cadenza.sources.landed import pages_while
    import datetime as dt
    mark = dt.datetime(2024, 1, 1)

    def page(*hours):
        return ("s", ([(("p%d" % i, "t", "u", None if h is None else 1704067200.0 + 3600 * h, None),) for i, h in enumerate(hours)],), mark)

    schema = ("source string, data struct<children:array<struct<data:struct<id:string,title:string,url:string,created_utc:double,"
              "link_flair_text:string>>>>, last_time timestamp_ntz")
    got = pages_while(spark.createDataFrame([page(3, 2, -1, 5), page(1, None, 4), page(-1), page(), page(2, 1)], schema)).select(
        F.size("data.children").alias("n")).collect()
    assert [r["n"] for r in got] == [2, 1, 0, 0, 2]


def test_post_frame_order(spark):
    """Pages keep the landed order of their posts, whatever the partitioning after."""
    from cadenza.sources.landed import feed_posts
    pages = spark.createDataFrame([("s", ([((f"p{i}", "t", "u", 1.0 * i, None),) for i in (4, 1, 3)],))],
                                  "source string, data struct<children:array<struct<data:struct<id:string,title:string,url:string,"
                                  "created_utc:double,link_flair_text:string>>>>")
    got = feed_posts(pages, F.lit("x")).repartition(3).orderBy("source", "page", "pos").collect()
    assert [(r["pos"], r["post_id"]) for r in got] == [(0, "p4"), (1, "p1"), (2, "p3")]


def test_json_is_parsed_once_a_row(spark):
    lines = spark.createDataFrame([(1, '{"a": 1, "b": {"c": "x"}}'), (2, '{"a": "x"}'), (3, "{"), (4, '{"a": 2, "z": [1]}'), (5, None)], "k int, value string")
    got = CK.check_json(lines, T.StructType.fromDDL("a int, b struct<c:string>"))
    for df in (got.good, got.bad, got.told):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parse_json(") + plan.count("parseJson") <= 1 and plan.count("from_json(") <= 1
    good, bad = got
    told = {x["k"]: x for x in got.told.select("k", "row", "reasons", F.to_json(F.map_keys("unknown")).alias("names")).collect()}
    assert {k for k, x in told.items() if not x["reasons"]} == {x["k"] for x in good.collect()} == {1, 4}
    assert {k: x["reasons"] for k, x in told.items() if x["reasons"]} == {x["k"]: x["reasons"] for x in bad.collect()}
    assert told[1]["row"] == (1, ("x",)) and told[2]["row"] is None and told[4]["names"] == '["z"]'

"""The extract job: state after data, idempotent re-run, page-size option."""

import datetime as dt

from pyspark.sql import functions as F

from cadenza.fixed import LAKE_COLUMNS
from cadenza.operators.feeds import newest_first, rules_table
from cadenza.operators.ingest import run_extract
from cadenza.plans import standins as S
from cadenza.sources import lake as LK
from cadenza.sources import state as ST

SF = "/root/testdata/sf0.001"


def test_extract_twice_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    S.land_extract_inputs(spark, SF, f"{root}/landing")
    rules = rules_table(spark)
    run1 = dt.datetime(2024, 1, 15, 12)
    m1 = {r["source"]: r["new_time"] for r in
          run_extract(spark, f"{root}/landing", rules, f"{root}/state", f"{root}/lake", run1).collect()}
    n1 = LK.read_lake(spark, f"{root}/lake").count()
    assert n1 > 0
    # marks moved forward for feeds that accepted a post, never backward
    assert all(v >= dt.datetime(2024, 1, 15) for v in m1.values())
    m2 = {r["source"]: r["new_time"] for r in
          run_extract(spark, f"{root}/landing", rules, f"{root}/state", f"{root}/lake",
                      run1 + dt.timedelta(hours=1)).collect()}
    assert LK.read_lake(spark, f"{root}/lake").count() == n1
    assert m2 == m1
    hist = ST.read_state(spark, f"{root}/state")
    assert hist.count() == 2 * len(m1)
    latest = {r["source"]: r["last_time"] for r in ST.latest_marks(hist).collect()}
    assert latest == m1


def test_lake_rows_have_declared_schema(spark, tmp_path):
    root = str(tmp_path)
    S.land_extract_inputs(spark, SF, f"{root}/landing")
    run_extract(spark, f"{root}/landing", rules_table(spark), f"{root}/state", f"{root}/lake",
                dt.datetime(2024, 1, 15, 12))
    day = LK.read_lake_day(spark, f"{root}/lake", "2024-01-15")
    assert [(f.name, f.dataType.simpleString()) for f in day.schema.fields] == LAKE_COLUMNS


def test_newest_first_page_size(spark):
    rows = [("a", str(i), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i)) for i in range(250)]
    rows += [("b", "x", dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "source string, post_id string, created timestamp_ntz")
    out = newest_first(df, ["source"], 100)
    got = out.groupBy("source").agg(F.count("*").alias("n"), F.min("created").alias("t")).collect()
    assert {r["source"]: r["n"] for r in got} == {"a": 100, "b": 1}
    assert {r["source"]: r["t"] for r in got}["a"] == dt.datetime(2024, 1, 1) + dt.timedelta(minutes=150)


def test_retry_after_crash_does_not_duplicate(spark, tmp_path):
    """Data written, state not committed (simulated by dropping the state): the
    retry re-reads the same posts but appends none twice."""
    root = str(tmp_path)
    S.land_extract_inputs(spark, SF, f"{root}/landing")
    rules = rules_table(spark)
    run = dt.datetime(2024, 1, 15, 12)
    run_extract(spark, f"{root}/landing", rules, f"{root}/state-a", f"{root}/lake", run)
    n1 = LK.read_lake(spark, f"{root}/lake").count()
    run_extract(spark, f"{root}/landing", rules, f"{root}/state-b", f"{root}/lake", run)
    lake = LK.read_lake(spark, f"{root}/lake")
    assert lake.count() == n1 == lake.select("post_id").distinct().count()


def test_filter_mode_equals_takewhile_on_sorted_feed(spark, tmp_path):
    """Metamorphic: on a newest-first feed the take-while and the plain
    filter keep the same posts."""
    from cadenza.operators.ingest import accepted_posts
    from cadenza.sources import landed as L
    root = str(tmp_path)
    S.land_extract_inputs(spark, SF, f"{root}/landing")
    rules = rules_table(spark)
    marks = ST.marks_with_default(rules, ST.latest_marks(ST.read_state(spark, f"{root}/state")),
                                  "2024-01-15")
    posts = L.read_feed_pages(spark, f"{root}/landing/pages")
    a = sorted(r["post_id"] for r in accepted_posts(posts, rules, marks, "takewhile").collect())
    b = sorted(r["post_id"] for r in accepted_posts(posts, rules, marks, "filter").collect())
    assert a == b and len(a) > 0


def test_only_landed_folders_since_the_mark_are_read(spark, tmp_path):
    """A folder older than every mark is not read: what lies there (here the same pages and
    lookups once more) changes nothing, and the plan shows the partition filter."""
    from cadenza.sources import landed as L
    root = str(tmp_path)
    S.land_extract_inputs(spark, SF, f"{root}/landing")
    rules = rules_table(spark)
    run = dt.datetime(2024, 1, 15, 12)
    run_extract(spark, f"{root}/landing", rules, f"{root}/state-a", f"{root}/lake-a", run)
    S.land_extract_inputs(spark, SF, f"{root}/landing", "2023-12-31")
    run_extract(spark, f"{root}/landing", rules, f"{root}/state-b", f"{root}/lake-b", run)
    a, b = (sorted(map(tuple, LK.read_lake(spark, f"{root}/lake-{x}").fillna(-1).collect()), key=repr) for x in "ab")
    assert a == b and len(a) > 0
    pages = f"{root}/landing/pages"
    every, new = L.read_feed_pages(spark, pages), L.read_feed_pages(spark, pages, "2024-01-15")
    assert every.count() == 2 * new.count()
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(run_date" in plan


def test_landed_without_run_dates_is_read_whole(spark, tmp_path):
    from cadenza.sources import landed as L
    path = str(tmp_path / "features")
    (spark.createDataFrame([("t1",), ("t2",)], "track_id string").write.json(path))
    assert L.landed(spark, L.AUDIO_SCHEMA, path, "2024-01-15").count() == 2


def test_search_results_are_made_per_brand(spark):
    """A brand's list is collected once; posts are neither paired with ten tracks each nor grouped again."""
    from cadenza.plans import standins as S

    sf = "/root/testdata/sf0.001"
    part = S.table(spark, sf, "part")
    got = S.search_results(S.extract_posts(spark, sf), part)
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [line for line in plan if "Aggregate [post_id" in line]
    brand = {f"p{x['p_partkey']}": x["p_brand"] for x in part.collect()}
    first = {}
    for key, b in sorted((x["p_partkey"], x["p_brand"]) for x in part.collect()):
        first.setdefault(b, []).append(f"t{key}")
    assert {x["post_id"]: [t["id"] for t in x["tracks"]["items"]] for x in got.collect()} == {k: first[b][:10] for k, b in brand.items()}

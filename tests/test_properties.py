
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadenza.functions.titles import clean_titles

ALPHABET = st.sampled_from(list("ab -()[]_.,'&é字९² \t") + ["Ós", "ß", " - "])
TITLES = st.lists(ALPHABET, min_size=0, max_size=14).map("".join)


GOLDEN = [
    ("Artist - Song (Live)", ("Artist - Song ", "Artist", "Song", "Artist Song ")),
    ("A (x) - Song [y]", ("A (x) - Song ", "A (x)", "Song", "A x Song ")),
    ("A - B [c] (d)", ("A - B ", "A", "B", "A B ")),
    ("A - B (d) [c]", ("A - B ", "A", "B", "A B ")),
    ("A - B - C", ("A - B - C", "A", "B", "A B C")),
    ("A[ - B ] c", ("A[ - B ] c", "A[", "B ] c", "A B c")),
    ("\tA_1 -  é & ß", ("\tA_1 -  é & ß", "A_1", "é & ß", " A 1 é ß")),
    ("no separator (x)", None),
]


def test_title_cleaning_golden(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(GOLDEN)], "id int, title string")
    got = {r["id"]: (r["truncated"], r["part0"], r["part1"], r["search_text"]) for r in clean_titles(df, "title").collect()}
    for i, (t, want) in enumerate(GOLDEN):
        assert got.get(i) == want, repr(t)


@settings(max_examples=60, deadline=None)
@given(st.lists(TITLES, min_size=1, max_size=40))
def test_title_cleaning_properties(spark, titles):
    """What is kept is a prefix that holds the separator; it ends at a bracket or is the whole
    title; parts are its stripped pieces; the search text has letters, digits and single blanks."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "id int, title string")
    got = {r["id"]: r for r in clean_titles(df, "title").collect()}
    assert set(got) == {i for i, t in enumerate(titles) if " - " in t}
    for i, r in got.items():
        t, kept = titles[i], r["truncated"]
        assert t.startswith(kept) and " - " in kept
        assert kept == t or t[len(kept)] in "(["
        assert r["part0"] == r["part0"].strip() and kept.lstrip().startswith(r["part0"])
        assert r["part1"] == r["part1"].strip() and r["part1"] in kept
        assert re.fullmatch(r"(?:[^\W_]| (?! ))*", r["search_text"])
        assert re.sub(r"[\W_]", "", kept) == r["search_text"].replace(" ", "")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_label_plan_has_no_row_python(spark):
    from cadenza.operators.labels import with_major_genre
    df = spark.createDataFrame([("indie rock, pop",), ("jazz",)], "genres string")
    plan = _plan(with_major_genre(df))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" in plan


def test_labels_need_one_shuffle_on_the_list(spark):
    from cadenza.operators.labels import label_map
    plan = _plan(label_map(spark.createDataFrame([("indie rock, pop",), ("jazz",)], "genres string")))
    assert plan.count("Exchange hashpartitioning(genres") == 1 and plan.count("ArrowEvalPython") == 1


def test_html_helper_runs_once_per_post(spark):
    from cadenza.functions.text import html_unescape
    from cadenza.functions.titles import has_separator
    df = spark.createDataFrame([("a &amp; b - c",), (None,)], "title string")
    out = df.withColumn("t", html_unescape(F.col("title"))).where(has_separator(F.col("t"))).select("t")
    assert _plan(out).count("ArrowEvalPython") == 1 and [r["t"] for r in out.collect()] == ["a & b - c"]


def test_match_plan_scores_once_and_limits_map_side(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["entity_match"](spark, "/root/testdata/sf0.001"))
    assert plan.count("ArrowEvalPython") == 1
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) + final
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_report_scans_lake_once(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["genre_report"](spark, "/root/testdata/sf0.001"))
    assert plan.count("lineitem.parquet") == 1


def test_hot_key_operators_combine_map_side(spark):
    """Per-group first/latest/stop points and report partials aggregate before the shuffle
    (a group holding a third of all rows is reduced inside every map task)."""
    from pyspark.sql import functions as F
    from cadenza.operators.feeds import take_while
    from cadenza.operators.ranking import first_per_group
    from cadenza.operators.reports import genre_partials
    from cadenza.sources.state import latest_marks
    df = spark.range(0, 3000).select(
        F.when(F.col("id") < 1000, F.lit("hot")).otherwise((F.col("id") % 5).cast("string")).alias("source"),
        F.col("id").alias("pos"), (F.col("id") % 3 == 0).alias("ok"))
    tw = _plan(take_while(df, ["source"], F.col("pos"), F.col("ok"), broadcast_stops=False))
    assert "partial_min" in tw
    fp = _plan(first_per_group(df, ["source"], F.col("pos"), ["ok"]))
    assert "partial_min_by" in fp
    hist = df.select("source", F.timestamp_seconds("pos").cast("timestamp_ntz").alias("last_time"),
                     F.timestamp_seconds("pos").cast("timestamp_ntz").alias("committed_at"))
    assert "partial_max_by" in _plan(latest_marks(hist))
    rows = df.select(F.col("source").alias("genres"), F.lit(1).alias("track_popularity"),
                     F.lit(0.5).alias("danceability"), F.lit(0.5).alias("energy"),
                     F.lit(0.5).alias("valence"), F.lit(-5.0).alias("loudness"))
    assert "partial_sum" in _plan(genre_partials(rows))


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(min_value=0, max_value=4e9, allow_nan=False), min_size=1, max_size=30))
def test_epoch_text_matches_python(spark, epochs):
    """Epoch seconds -> 'yyyy-MM-dd HH:mm:ss' in the session time zone (UTC here),
    fractions dropped, as datetime.fromtimestamp(...).strftime does."""
    import datetime as dt
    from pyspark.sql import functions as F
    from cadenza.functions.dates import epoch_to_text
    df = spark.createDataFrame([(i, e) for i, e in enumerate(epochs)], "i int, e double")
    got = {r["i"]: r["t"] for r in df.select("i", epoch_to_text(F.col("e")).alias("t")).collect()}
    for i, e in enumerate(epochs):
        want = dt.datetime.fromtimestamp(int(e), dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        assert got[i] == want

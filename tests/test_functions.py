"""Golden values for the scalar operators (FIXTURES.md section 2)."""


import pytest
from pyspark.sql import functions as F

from cadenza.functions.similarity import ratio_upper_bound, similarity_ratio
from cadenza.functions.text import html_unescape, is_media_link, permalink
from cadenza.functions.titles import clean_titles, remove_tags, py_strip
from cadenza.functions.prefs import label_value

TITLES = [
    ("Artist - Song (Official) [Rock]", "Artist - Song ", "Artist", "Song", "Artist Song "),
    ("[FRESH] Artist - Song (feat. B)", "[FRESH] Artist - Song ", "[FRESH] Artist", "Song",
     " FRESH Artist Song "),
    ("(A) B - C (live)", "(A) B - C (live)", "(A) B", "C (live)", " A B C live "),
    ("A - B - C [2020]", "A - B - C ", "A", "B", "A B C "),
    ("Sigur Rós - Sæglópur (x)", "Sigur Rós - Sæglópur ", "Sigur Rós", "Sæglópur",
     "Sigur Rós Sæglópur "),
    ("A - (B) C", "A - ", "A", "", "A "),
    ("A - B [x] (y)", "A - B ", "A", "B", "A B "),
]


def test_title_cleaning(spark):
    df = spark.createDataFrame([(t[0],) for t in TITLES] + [("no separator",)], "title string")
    got = {r["title"]: (r["truncated"], r["part0"], r["part1"], r["search_text"])
           for r in clean_titles(df, "title").collect()}
    assert "no separator" not in got
    for title, trunc, p0, p1, st in TITLES:
        assert got[title] == (trunc, p0, p1, st), title


def test_tag_removal_then_clean(spark):
    df = spark.createDataFrame([("[FRESH] Artist - Song (feat. B)",)], "title string")
    r = clean_titles(df, "title", tags=["[FRESH]", "[FRESH VIDEO]", "[FRESH ALBUM]", "[ORIGINAL]"]).first()
    assert r["part0"] == "Artist" and r["part1"] == "Song"
    arr = spark.createDataFrame([("x[FRESH VIDEO]y", ["[FRESH]", "[FRESH VIDEO]"])], "t string, tags array<string>")
    assert arr.select(remove_tags(F.col("t"), F.col("tags")).alias("o")).first()["o"] == "x[FRESH VIDEO]y".replace("[FRESH]", "").replace("[FRESH VIDEO]", "")


def test_py_strip_unicode_whitespace(spark):
    df = spark.createDataFrame([("　\t a b  \n",)], "s string")
    assert df.select(py_strip(F.col("s")).alias("o")).first()["o"] == "　\t a b  \n".strip()


def test_html_unescape(spark):
    df = spark.createDataFrame([("Simon &amp; Garfunkel - Bridge &#39;70",), ("plain",), (None,)], "s string")
    out = [r["o"] for r in df.select(html_unescape(F.col("s")).alias("o")).collect()]
    assert out == ["Simon & Garfunkel - Bridge '70", "plain", None]


RATIOS = [
    ("Blinding Lights", "Blinding Lights", 1.0),
    ("Blinding Lights - Remix", "Blinding Lights", 0.7894736842105263),
    ("The Weeknd", "the weeknd", 0.8),
    ("Tame Impala", "Tame Impala ", 0.9565217391304348),
    ("", "", 1.0),
    ("a", "", 0.0),
    ("tide", "diet", 0.25),
    ("diet", "tide", 0.5),
]


def test_similarity_ratio(spark):
    df = spark.createDataFrame([(a, b) for a, b, _ in RATIOS], "a string, b string")
    got = [r["r"] for r in df.select(similarity_ratio("a", "b").alias("r")).collect()]
    assert got == [r for _, _, r in RATIOS]
    bounds = [r["u"] for r in df.select(ratio_upper_bound(F.col("a"), F.col("b")).alias("u")).collect()]
    assert all(u >= r for u, (_, _, r) in zip(bounds, RATIOS))


def test_link_predicate_and_permalink(spark):
    urls = [("https://youtu.be/x",), ("https://open.spotify.com/t",), ("https://a.bandcamp.com",),
            ("https://soundcloud.com/a",), ("https://example.com/Spotify",), (None,)]
    df = spark.createDataFrame(urls, "url string")
    assert [r["m"] for r in df.select(is_media_link(F.col("url")).alias("m")).collect()] == \
        [True, True, True, True, False, False]
    r = spark.range(1).select(permalink(F.lit("https://x/r/Music/comments/"), F.lit("abc")).alias("p")).first()
    assert r["p"] == "https://x/r/Music/comments/abc"


def test_preference_values(spark):
    df = spark.createDataFrame([("Rhythmic",), ("",), ("bogus",)], "l string")
    mid = [r["v"] for r in df.select(label_value("danceability", F.col("l")).alias("v")).collect()]
    assert mid == [pytest.approx(0.45), 0.5, None]
    uni = [r["v"] for r in df.select(label_value("danceability", F.col("l"), mode="uniform", seed=7)
                                       .alias("v")).collect()]
    assert 0.3 <= uni[0] <= 0.6 and uni[1] == 0.5 and uni[2] is None


def test_corrected_loudness_table(spark):
    from cadenza.functions.prefs import CORRECTED_BUCKETS, CORRECTED_NOT_CHOSEN
    df = spark.createDataFrame([("Very Loud",), ("",)], "l string")
    out = [r["v"] for r in df.select(label_value("loudness", F.col("l"), buckets=CORRECTED_BUCKETS,
                                                 not_chosen=CORRECTED_NOT_CHOSEN).alias("v")).collect()]
    assert out == [-2.5, -10.1]

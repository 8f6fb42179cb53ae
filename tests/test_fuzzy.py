"""Candidates without shared words: the q-gram index against the full comparison."""

import random

from pyspark.sql import functions as F

from cadenza.operators.fuzzy import bigrams, fuzzy_pairs
from cadenza.operators.matching import block_candidates, match_posts


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def misspell(r, s, n):
    s = list(s)
    for _ in range(n):
        i = r.randrange(len(s) + 1)
        s[i:i + r.choice([0, 1])] = r.choice(["", "x", "é"])
    return "".join(s)


def test_fuzzy_pairs_lose_nothing(spark):
    r = random.Random(3)
    names = ["".join(r.choices("abc é", k=r.randint(0, 18))) for _ in range(140)] + ["aaaaaaaa", "aaaaaaa", "abababab", "babababa", "", "a", "b"]
    texts = [misspell(r, r.choice(names), r.randint(0, 6)) for _ in range(160)] + ["", "A", "AAAAAAAA", None]
    left = [(r.choice("pq"), t) for t in texts] + [("p", texts[0])]
    right = [(r.choice("pq"), t) for t in names] + [("p", None), (None, "a")]
    a, b = spark.createDataFrame(left, "block string, part0 string"), spark.createDataFrame(right, "block string, track_name string")
    for rate in (0.3, 0.15, 0.0, 0.45):
        want = set()
        for ba, x in left:
            for bb, y in right:
                if ba == bb and x is not None and y is not None:
                    d = distance(x.lower(), y.lower())
                    if d <= int(rate * max(len(x), len(y)) + 1e-9):
                        want.add((ba, x.lower(), y.lower(), d))
        got = [tuple(x) for x in fuzzy_pairs(a, b, rate=rate).collect()]
        assert len(got) == len(set(got)) and set(got) == want, rate
    assert fuzzy_pairs(a.limit(0), b).count() == 0


def test_fuzzy_plan_has_no_cartesian_product(spark):
    a = spark.createDataFrame([("p", "abc")], "block string, part0 string")
    b = spark.createDataFrame([("p", "abd")], "block string, track_name string")
    plan = fuzzy_pairs(a, b)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_bigrams_tell_occurrences_apart(spark):
    got = spark.createDataFrame([("aaa",), ("",)], "t string").select(bigrams(F.col("t")).alias("g")).collect()
    assert len(got[0]["g"]) == len(set(got[0]["g"])) == 4 and len(got[1]["g"]) == 1


def test_exact_name_goes_first_and_misspelt_names_match(spark):
    catalogue = spark.createDataFrame(
        [(i, f"Love {i}", "Ann", "Ann", i) for i in range(20)] + [(99, "Love", "Ann", "Ann", 99), (50, "Midnight Train", "Ann", "Ann", 50)],
        "track_id long, track_name string, artists_name string, block string, rank_key long")
    posts = spark.createDataFrame([(1, "Love - Ann", "Ann", 1, 1, "Love", "Ann"), (2, "Midnigth-Train - Ann", "Ann", 1, 2, "Midnigth-Train", "Ann")],
                                  "post_id long, title string, block string, ord int, pos int, part0 string, part1 string")
    first = block_candidates(posts, catalogue).where("cand_rank = 1 and post_id = 1").collect()
    assert [x["track_id"] for x in first] == [99]
    assert {x["post_id"]: x["track_id"] for x in match_posts(posts, catalogue).collect()} == {1: 99}
    assert {x["post_id"]: x["track_id"] for x in match_posts(posts, catalogue, fuzzy_rate=0.3).collect()} == {1: 99, 2: 50}


def test_bigrams_are_made_of_distinct_strings(spark):
    """Of an inner explode Spark infers a filter on the bigrams and moves it below the distinct, to every row read."""
    rows = spark.range(100).select(F.lit("b").alias("block"), F.concat(F.lit("name "), F.col("id") % 3).alias("part0"))
    plan = fuzzy_pairs(rows, rows.withColumnRenamed("part0", "track_name"))._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "array_sort" in line]
